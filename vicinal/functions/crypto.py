"""Column encryption under a caller-held key, with Spark's own AES functions.

The key travels as a one-row DataFrame read by a scalar subquery, so that no plan,
event log or UI page prints it. The row's id is bound in as associated data: a
ciphertext moved to another row no longer decrypts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinal.functions.vectors import pack_vector, unpack_vector
from vicinal.options import check_key

_CHECK_TEXT = b"vicinal-key-check"


def key_frame(spark: SparkSession, key: bytes) -> DataFrame:
    return spark.createDataFrame([(bytearray(check_key(key)),)], "key binary")


def seal(plain: Column, key: Column, aad: Column) -> Column:
    empty = F.lit(b"").cast("binary")
    return F.aes_encrypt(plain, key, F.lit("GCM"), F.lit("DEFAULT"), empty, _aad(aad))


def unseal(cipher: Column, key: Column, aad: Column) -> Column:
    """Null when the key, or the row the ciphertext belongs to, is another one."""
    return F.try_aes_decrypt(cipher, key, F.lit("GCM"), F.lit("DEFAULT"), _aad(aad))


def encrypt_columns(df: DataFrame, cols: Iterable[str], key_df: DataFrame, id_col: str = "id") -> DataFrame:
    """Replace the columns by ciphertext; strings, binaries, VARIANT and float arrays."""
    kinds = dict(df.dtypes)
    key = key_df.scalar()
    sealed = {}
    for name in cols:
        plain = _to_binary(F.col(name), kinds[name])
        sealed[name] = seal(plain, key, F.col(id_col))
    return df.withColumns(sealed) if sealed else df


def decrypt_columns(df: DataFrame, cols: dict[str, str], key_df: DataFrame, id_col: str = "id") -> DataFrame:
    """Undo :func:`encrypt_columns`; ``cols`` maps each name to its plain type.

    A row that does not decrypt raises instead of turning into nulls.
    """
    key = key_df.scalar()
    opened = {}
    for name, kind in cols.items():
        plain = unseal(F.col(name), key, F.col(id_col))
        failed = F.col(name).isNotNull() & plain.isNull()
        guarded = F.when(failed, F.raise_error(F.lit(f"{name} does not decrypt under this key"))).otherwise(plain)
        opened[name] = _from_binary(guarded.cast("binary"), kind)
    return df.withColumns(opened) if opened else df


def key_check(spark: SparkSession, key: bytes, name: str) -> bytes:
    """Ciphertext of a fixed text: opens only under the key it was made with."""
    row = key_frame(spark, key).select(
        seal(F.lit(_CHECK_TEXT).cast("binary"), F.col("key"), F.lit(name)).alias("check")
    )
    return bytes(row.first()["check"])


def key_opens(spark: SparkSession, key: bytes, name: str, check: bytes) -> bool:
    row = key_frame(spark, key).select(
        unseal(F.lit(bytes(check)).cast("binary"), F.col("key"), F.lit(name)).alias("text")
    )
    text = row.first()["text"]
    return text is not None and bytes(text) == _CHECK_TEXT


def _aad(column: Column) -> Column:
    return column.cast("string").cast("binary")


def _to_binary(column: Column, kind: str) -> Column:
    if kind.startswith("array<float"):
        return pack_vector(column)
    if kind == "variant" or kind.startswith("array<"):
        return F.to_json(column).cast("binary")
    return column.cast("binary")


def _from_binary(column: Column, kind: str) -> Column:
    if kind == "variant":
        return F.parse_json(column.cast("string"))
    if kind.startswith("array<float"):
        return unpack_vector(column)
    if kind.startswith("array<"):
        return F.from_json(column.cast("string"), kind)
    return column.cast(kind)
