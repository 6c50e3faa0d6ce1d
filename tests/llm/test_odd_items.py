"""Benchmark items with few plain words, of few words, without blanks, and with names at sentence beginnings."""

from vicinal.llm.decontamination import contaminated

ITEMS = [
    (1, "Compute 12 + 7 + 3 + 9 + 41 + 5 + 8 + 6"), (2, "capital of France?"), (3, "小明有三个苹果，他又买了五个梨。请问他现在一共有多少个水果？"),
    (4, "Alice buys 3 apples and 4 pears at market. Alice then eats 2 apples; how many remain today?"), (5, "Alice sells seven old books to Tom"),
]
FILL = "nothing of this belongs to any question and so on"
TEXTS = [
    f"{FILL} Compute 12 + 7 + 3 + 9 + 41 + 5 + 8 + 6 {FILL}", "Compute 12 + 7 + 3 + 9 + 42 + 5 + 8 + 6",
    "12 7 3 9 41 5 8 6 Compute 12 7 3 9 41 5", f"{FILL} the capital of france {FILL}", "capital cities of France",
    "前文很长。小明有三个苹果，他又买了五个梨。请问他现在一共有多少个水果？后文", "今天天气很好，我们一起去公园散步吧。",
    f"{FILL}. Carol buys 5 apples and 6 pears at market. Carol then eats 1 apples; how many remain today? {FILL}",
    ITEMS[3][1].lower(), f"{FILL}. Carol buys 5 apples and 6 pears at market. Dave then eats 1 apples; how many remain today?",
    f"{FILL}. Bob sells seven old books to Ann. {FILL}", None,
]


def test_every_item_is_looked_for(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").repartition(2)
    rows = contaminated(docs, "doc_id", "text", spark.createDataFrame(ITEMS, "item_id bigint, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): r["changed"] for r in rows}
    assert got == {(0, 1): False, (3, 2): False, (5, 3): False, (7, 4): True, (8, 4): False, (10, 5): True}
