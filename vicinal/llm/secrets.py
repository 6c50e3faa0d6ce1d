"""Secrets in text: fixed shapes, and strings that no dictionary helps to compress."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinal.llm.common import text_slices

#: The base shapes. Letters of the key words match in either case, ASCII only.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
LEAST = {"assign": 12, "access": 18}
KINDS = ("assign", "access", "hex", "novel")

#: Words after which an incompressible string is suspicious.
SENSITIVE = re.compile(
    r"password|passwd|passphrase|pwd|secret|token|api_?key|access_?key|private_?key|auth|credential|bearer|signature",
    re.IGNORECASE | re.ASCII,
)
CANDIDATE_LEAST = 12
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{CANDIDATE_LEAST},}}")
#: Code points between a sensitive word and the candidate, and of surrounding text that primes the compressor.
REACH, AROUND = 48, 512
#: Longest part of a candidate that is compressed at once; longer ones are measured part by part.
PART = 4096
#: Marginal compressed bits per byte from which a candidate counts as incompressible.
NOVEL_BITS = 5.0

#: Identifiers that are common in code and configuration.
IDENTIFIERS = (
    "abstract access account address application argument array assert async attribute authorization await base64 "
    "boolean branch buffer callback catch certificate channel character class client collection column command "
    "component config configuration connection constant constructor container content context continue controller "
    "cookie count credentials database default define delete description destination directory document element "
    "encoding endpoint environment error event exception execute export extends false field filename final float "
    "format function generate global handler header hostname identifier implements import include index initialize "
    "input instance integer interface internal iterator language length library listener localhost location logger "
    "management manager message metadata method module namespace number object operation option output package "
    "parameter parent parser password path pattern pointer port position prefix private process project property "
    "protected protocol provider public query queue reference register remote repository request require resource "
    "response result return schema secret section sequence server service session setting signature source static "
    "status storage stream string struct suffix system table target template thread throws timeout timestamp token "
    "transaction transform true type undefined unsigned update url user username validate value variable vector "
    "version virtual void volatile while width window worker wrapper"
)


@lru_cache(maxsize=1)
def _compressor() -> zstandard.ZstdCompressor:
    """A compressor primed with the identifiers."""
    level = zstandard.ZstdCompressionParameters.from_level(3, write_checksum=0, write_content_size=0, write_dict_id=0)
    primer = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(compression_params=level, dict_data=primer)


def marginal_bits(before: str, candidate: str, after: str = "") -> float:
    """Bits per byte that the candidate adds once its surroundings and the identifiers are known."""
    own, known = candidate.encode(), f"{before}\n{after}\n".encode()
    compress = _compressor().compress
    base = len(compress(known))
    added = sum(max(0, len(compress(known + own[at : at + PART])) - base) for at in range(0, len(own), PART))
    return 8.0 * added / max(1, len(own))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed shapes, ordered by start, then kind."""
    spans = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST["assign"]]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m.group()) >= LEAST["access"]]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _candidates(text: str, start: int, stop: int) -> Iterator[re.Match]:
    """Candidates that begin up to ``stop``; what lies behind is not looked at, so many words cost no more than the text."""
    while first := CANDIDATE.search(text, start, min(len(text), stop + CANDIDATE_LEAST)):
        whole = CANDIDATE.match(text, first.start())
        yield whole
        start = whole.end()


def novel_spans(text: str, known: list[tuple[int, int, int]], least_bits: float = NOVEL_BITS) -> list[tuple[int, int, int]]:
    """Further spans: strings near a sensitive word that stay incompressible beside their surroundings.

    A string counts only if it mixes letters and digits, or upper and lower case inside, and lies outside
    the spans already ``known``.
    """
    found, taken, at = [], sorted((s, e) for s, _, e in known), 0
    last = 0
    for word in SENSITIVE.finditer(text):
        stop = min(len(text), word.end() + REACH)
        for m in _candidates(text, max(word.end(), last), stop):
            last = m.end()
            while at < len(taken) and taken[at][1] <= m.start():
                at += 1
            if at < len(taken) and taken[at][0] < m.end():
                continue
            own = m.group()
            mixed = bool(re.search("[0-9]", own)) and bool(re.search("[A-Za-z]", own)) or bool(re.search("[a-z][A-Z]", own))
            if not mixed:
                continue
            before, after = text[max(0, m.start() - AROUND) : m.start()], text[m.end() : m.end() + AROUND]
            if marginal_bits(before, own, after) >= least_bits:
                found.append((m.start(), 3, m.end()))
    return found


def as_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(docs: DataFrame, id_col: str, text_col: str, least_bits: float = NOVEL_BITS) -> DataFrame:
    """``(id, n_assign, n_access, n_hex, n_novel, base_spans, spans)`` of every row.

    Spans are ``kind:start:end`` in code points with an exclusive end, ordered by start and then kind:
    assign, access, hex (fixed shapes) and novel (found by compression). Null and empty texts have none.
    Texts are scanned whole; rows are independent, so repeated ids give repeated rows, an empty table an
    empty result, and other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                base = [base_spans(t) if t else [] for t in part.column("_text").to_pylist()]
                more = [novel_spans(t, b, least_bits) if t else [] for t, b in zip(part.column("_text").to_pylist(), base)]
                counts = [pa.array([sum(k == kind for _, k, _ in b) for b in base], pa.int64()) for kind in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_id"), *counts, pa.array([len(m) for m in more], pa.int64()),
                        pa.array([as_text(b) for b in base], pa.string()),
                        pa.array([as_text(sorted(b + m)) for b, m in zip(base, more)], pa.string()),
                    ],
                    [id_col, "n_assign", "n_access", "n_hex", "n_novel", "base_spans", "spans"],
                )

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = dict(rows.dtypes)["_id"]
    return rows.mapInArrow(
        run,
        f"`{id_col}` {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_novel bigint, base_spans string, spans string",
    )
