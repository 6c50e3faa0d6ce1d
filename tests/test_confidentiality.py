import pytest
from pyspark.sql import functions as F

from vicinal.functions.crypto import decrypt_columns, encrypt_columns, key_check, key_frame, key_opens
from vicinal.functions.vectors import pack_vector, unpack_vector
from vicinal.operators.items import as_items

KEY = b"0123456789abcdef0123456789abcdef"
KINDS = {"vector": "array<float>", "contents": "string", "metadata": "variant"}


@pytest.fixture
def items(spark):
    rows = [("a", [0.1, -2.5e10, 1e-10], "héllo", '{"x": [1, {"y": "z"}]}'), ("b", None, None, None)]
    return as_items(spark.createDataFrame(rows, "id string, vector array<float>, contents string, metadata string"))


def _plain(df):
    return sorted(df.select("id", "vector", "contents", F.to_json("metadata").alias("m")).collect())


def test_round_trip_and_wrong_key(spark, items):
    sealed = encrypt_columns(items, KINDS, key_frame(spark, KEY))
    assert {t for n, t in sealed.dtypes if n != "id"} == {"binary"}
    assert _plain(decrypt_columns(sealed, KINDS, key_frame(spark, KEY))) == _plain(items)
    with pytest.raises(Exception, match="does not decrypt"):
        decrypt_columns(sealed, KINDS, key_frame(spark, KEY[::-1])).collect()


def test_ciphertext_is_bound_to_its_row(spark, items):
    sealed = encrypt_columns(items.filter("id = 'a'"), ["contents"], key_frame(spark, KEY))
    moved = sealed.withColumn("id", F.lit("other"))
    with pytest.raises(Exception, match="does not decrypt"):
        decrypt_columns(moved, {"contents": "string"}, key_frame(spark, KEY)).collect()


def test_no_plan_prints_the_key(spark, items):
    sealed = encrypt_columns(items, KINDS, key_frame(spark, KEY))
    opened = decrypt_columns(sealed, KINDS, key_frame(spark, KEY))
    opened.collect()
    plan = opened._jdf.queryExecution().toString()
    assert KEY.decode() not in plan and KEY.hex() not in plan.lower()


@pytest.mark.parametrize("key", [b"short", b"x" * 31, b"x" * 33, "x" * 32, None])
def test_key_must_be_32_bytes(spark, key):
    with pytest.raises(ValueError):
        key_frame(spark, key)


def test_key_check(spark):
    check = key_check(spark, KEY, "name")
    assert key_opens(spark, KEY, "name", check)
    assert not key_opens(spark, KEY[::-1], "name", check)
    assert not key_opens(spark, KEY, "other", check)


def test_packed_vectors(spark, items):
    packed = items.select("id", "vector", pack_vector("vector").alias("p"))
    assert {r["id"]: None if r["p"] is None else len(r["p"]) for r in packed.collect()} == {"a": 12, "b": None}
    assert all(r["vector"] == r["v"] for r in packed.select("vector", unpack_vector("p").alias("v")).collect())
