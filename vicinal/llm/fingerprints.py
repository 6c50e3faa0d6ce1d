"""Document fingerprints from prefix polynomial hashes."""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Two prime moduli below 2^31 and a base for each: products stay below 2^62.
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 1299721)
#: Code points of a sampled span, and how many sampled spans a fingerprint keeps.
SPAN, SPANS = 12, 32
#: Bytes of text that a range of ids aims at.
RANGE_BYTES = 32 << 20
#: Prefix and suffix lengths that a fingerprint keeps: this one, then a quarter power of two more each.
FIRST_LENGTH = 8

_POWERS: list[np.ndarray] = [np.ones(1, np.int64), np.ones(1, np.int64)]
_INVERSE = tuple(pow(b, -1, p) for b, p in zip(BASES, PRIMES))


def _powers(which: int, size: int) -> np.ndarray:
    """Powers of a base, doubled as texts get longer."""
    known = _POWERS[which]
    while len(known) < size:
        step = pow(BASES[which], len(known), PRIMES[which])
        known = np.concatenate([known, known * step % PRIMES[which]])
    _POWERS[which] = known
    return known[:size]


class PrefixHashes:
    """Hashes of all prefixes of a text; any span compares in constant time.

    Equal spans always compare equal. Unequal ones of a text pair collide with a probability of about
    length / 2^62.
    """

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
        self.n = len(points)
        self.sums = []
        for which, prime in enumerate(PRIMES):
            # Code points are below 2^21 and powers below 2^31; reduced sums of 2^31 terms fit 62 bits.
            terms = points * _powers(which, self.n) % prime
            sums = np.zeros(self.n + 1, np.int64)
            np.cumsum(terms, out=sums[1:])
            self.sums.append(sums % prime)

    def span(self, start: int, end: int) -> int:
        """A number that depends on the code points from start to end alone."""
        parts = []
        for which, prime in enumerate(PRIMES):
            sums = self.sums[which]
            raw = (int(sums[end]) - int(sums[start])) % prime
            parts.append(raw * pow(_INVERSE[which], start, prime) % prime)
        return parts[0] << 31 | parts[1]

    def spans(self, width: int) -> np.ndarray:
        """The hashes of all spans of a width, scaled to a common power: comparable across texts."""
        if self.n < width:
            return np.zeros(0, np.uint64)
        prime, sums = PRIMES[0], self.sums[0]
        raw = (sums[width:] - sums[:-width]) % prime
        return (raw * _inverse_powers(self.n)[: len(raw)] % prime).astype(np.uint64)

    def common_extension(self, other: PrefixHashes, start: int = 0, other_start: int = 0) -> int:
        """How far both texts agree from the given places on, by binary search over prefixes."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            mid = (low + high + 1) // 2
            if self.span(start, start + mid) == other.span(other_start, other_start + mid):
                low = mid
            else:
                high = mid - 1
        return low


_DOWN = [np.ones(1, np.int64)]


def _inverse_powers(size: int) -> np.ndarray:
    known = _DOWN[0]
    while len(known) < size:
        known = np.concatenate([known, known * pow(_INVERSE[0], len(known), PRIMES[0]) % PRIMES[0]])
    _DOWN[0] = known
    return known[:size]


def lengths_to(n: int) -> list[int]:
    """The prefix lengths kept for a text of n code points."""
    found, k = [], 0
    while (length := int(FIRST_LENGTH * 2 ** (k / 4))) <= n:
        found.append(length)
        k += 1
    return found


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (values ^ (values >> np.uint64(31))) >> np.uint64(32)


class Fingerprint:
    """Length, whole hash, hashes of growing prefixes and suffixes, and the least hashes of short spans."""

    def __init__(self, text: str):
        hashes = PrefixHashes(text)
        self.n, self.whole = hashes.n, hashes.span(0, hashes.n)
        lengths = np.array(lengths_to(self.n), np.int64)
        prime, sums = PRIMES[0], hashes.sums[0]
        self.prefixes = sums[lengths].tolist()
        tails = (sums[self.n] - sums[self.n - lengths]) % prime
        self.suffixes = (tails * _inverse_powers(self.n + 1)[self.n - lengths] % prime).tolist()
        spans = _mixed(hashes.spans(SPAN))
        if len(spans) > 4 * SPANS:
            few = spans[spans <= np.partition(spans, 4 * SPANS)[4 * SPANS]]
            spans = few if len(np.unique(few)) >= SPANS else spans
        self.least = np.unique(spans)[:SPANS]

    def __str__(self) -> str:
        parts = [f"{self.n:x}", f"{self.whole:016x}"]
        parts += ["".join(f"{h:08x}" for h in block) for block in (self.prefixes, self.suffixes, self.least)]
        return "-".join(parts)

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal texts; else the greater of two shares, both below 1 for different texts.

        The share of the longer text that a common prefix and suffix cover, found by binary search over
        the kept lengths, and the share of common short spans, estimated from the least hashes.
        """
        if self.n == other.n and self.whole == other.whole:
            return 1.0
        ends = 0
        for own, its in ((self.prefixes, other.prefixes), (self.suffixes, other.suffixes)):
            lengths = lengths_to(min(self.n, other.n))
            at = bisect.bisect_left(range(len(lengths)), True, key=lambda k: own[k] != its[k])
            ends += lengths[at - 1] if at else 0
        cover = min(ends, min(self.n, other.n)) / max(self.n, other.n, 1)
        union = np.union1d(self.least, other.least)[:SPANS]
        both = np.isin(union, self.least) & np.isin(union, other.least)
        return float(min(max(cover, both.sum() / max(1, len(union))), 1 - 1 / (1 << 20)))


def fingerprint(text: str) -> str:
    return str(Fingerprint(text))


def _edit(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _rows(batches: Iterator[pa.RecordBatch], id_col: str) -> Iterator[pa.RecordBatch]:
    """Each row beside the one that follows it in its range; the last row of a range is there for that alone."""
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    last, out = None, []
    for batch in batches:
        kind = batch.schema.field("_id").type
        columns = [batch.column(c).to_pylist() for c in ("_range", "_tail", "_id", "_text")]
        for part, tail, own_id, text in zip(*columns):
            now = (part, tail, own_id, text or "", Fingerprint(text or ""))
            if last and last[0] == part and not last[1]:
                edited = _edit(last[3], now[3])
                changed = Fingerprint(edited)
                out.append((
                    last[2], last[4].n, hashlib.sha256(edited.encode()).hexdigest(), str(last[4]), str(changed),
                    last[4].likeness(changed), last[4].likeness(now[4]),
                ))
            last = now
        if out:
            kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
            out = []


class Ranges:
    """Consecutive ranges of rows by ``(id, hash of the text)``; a null id is below all others.

    An id that holds the rows of several ranges is cut into as many by the hash, null ids likewise.
    """

    def __init__(self, quantiles: list[float], null_parts: int):
        near = np.clip(np.array(quantiles, np.float64), -(2.0**63), 2.0**63 - 1024)
        ids, copies = np.unique(near.astype(np.int64), return_counts=True)
        parts = {int(i): int(n) for i, n in zip(ids, copies)}
        # What follows a heavy id begins a range of its own.
        for heavy in [i for i, n in parts.items() if n > 1]:
            parts.setdefault(heavy + 1, 1)
        self.cuts = np.array(sorted(parts), np.int64)
        self.parts = np.array([null_parts, 1, *(parts[i] for i in self.cuts.tolist())], np.int64)
        self.first = np.cumsum(self.parts) - self.parts
        self.total = int(self.parts.sum())

    def of(self, ids: np.ndarray, missing: np.ndarray, orders: np.ndarray) -> np.ndarray:
        """The range of every row; what stands in ``ids`` for a null does not matter."""
        at = np.where(missing, 0, 1 + np.searchsorted(self.cuts, ids, side="right"))
        drawn = (orders.astype(np.int64) ^ np.int64(-(1 << 63))).view(np.uint64) >> np.uint64(32)
        part = (drawn * self.parts[at].astype(np.uint64)) >> np.uint64(32)
        return (self.first[at] + part.astype(np.int64)).astype(np.int32)


def ranges_for(rows: DataFrame) -> Ranges:
    """Ranges of about ``RANGE_BYTES`` of text, and at least two for each shuffle partition."""
    least = 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.isnull("_id")).alias("nulls"), F.sum(F.octet_length("_text")).alias("b")).first()
    wanted = max(2, least, -(-(size["b"] or 0) // RANGE_BYTES))
    null_parts = max(1, -(-wanted * size["nulls"] // max(1, size["n"])))
    others = max(1, wanted - null_parts)
    steps = [n / others for n in range(1, others)]
    quantiles = rows.select("_id").approxQuantile("_id", steps, 0.2 / others) if steps else []
    return Ranges(quantiles, null_parts)


def fingerprint_neighbours(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like the neighbours are.

    Rows are ordered by descending integer id (null last; equal ids by a hash of the text). The edited
    text replaces the last half of the code points, rounded down, by as many from the start of the next
    row's text; the last row is followed by the first. Null texts count as empty. Columns: ``id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    One shuffle: rows go to ranges of ids and, where one id or the null id has many rows, of hashes; their number follows the
    bytes of all texts. The row that follows a range is sent to it as well, so a task holds one range, sorted on disk
    where need be, and one text at a time. Rows equal in id and text stay together. An empty table gives an empty result; repeated rows
    give a row each; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.withColumn("_order", F.xxhash64("_text"))
    ranges = ranges_for(rows)

    @F.pandas_udf("int")
    def in_range(ids: pd.Series, missing: pd.Series, orders: pd.Series) -> pd.Series:
        return pd.Series(ranges.of(ids.to_numpy(), missing.to_numpy(), orders.to_numpy()))

    filled, missing = F.coalesce("_id", F.lit(0)), F.isnull("_id")

    # The greatest row of every range: at most one for each cut. A null id is below all others.
    key = F.struct(F.col("_id"), F.col("_order"))
    firsts = rows.select(in_range(filled, missing, "_order").alias("_range"), key.alias("_key")).groupBy("_range").agg(F.max("_key").alias("_key")).collect()
    firsts = sorted((r["_range"], r["_key"]["_id"], r["_key"]["_order"]) for r in firsts)
    follows = {}
    for n, (_, own_id, order) in enumerate(firsts):
        follows.setdefault((own_id, order), []).append(firsts[(n + 1) % len(firsts)][0])
    marked = {(i or 0, i is None, o): n for (i, o), n in follows.items()}

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series, missing: pd.Series, orders: pd.Series) -> pd.Series:
        own = ranges.of(ids.to_numpy(), missing.to_numpy(), orders.to_numpy())
        return pd.Series([
            [r, *(-1 - n for n in marked.get((i, m, o), ()))]
            for i, m, o, r in zip(ids.tolist(), missing.tolist(), orders.tolist(), own.tolist())
        ])

    # -1 - n sends the row to range n as the one that follows it.
    spread = rows.withColumn("_place", F.explode(places(filled, missing, "_order")))
    spread = spread.withColumn("_tail", F.col("_place") < 0).withColumn(
        "_range", F.when(F.col("_place") < 0, -1 - F.col("_place")).otherwise(F.col("_place"))
    )
    dealt = spread.repartitionById(ranges.total, "_range").sortWithinPartitions("_range", "_tail", F.desc_nulls_last("_id"), F.desc("_order"))
    schema = (
        f"`{id_col}` bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return dealt.select("_range", "_tail", "_id", "_text").mapInArrow(lambda batches: _rows(batches, id_col), schema)
