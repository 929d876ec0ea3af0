from arrears.llm import preferences as p

SCHEMA = "conv_id bigint, turn int, role string, text string"


def render(rows, pair, section):
    mine = sorted((r for r in rows if r["pair_id"] == pair and r["section"] == section), key=lambda r: r["turn"])
    return "".join(r["header"] + r["body"] + r["footer"] for r in mine), [r["trained"] for r in mine]


def turns(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_prompt_is_the_longest_common_prefix(spark):
    common = [(1, 0, "system", "s"), (1, 1, "user", "q")]
    chosen = turns(spark, [*common, (1, 2, "assistant", "good"), (1, 3, "user", "more"), (1, 4, "assistant", "same")])
    rejected = turns(spark, [*common, (1, 2, "assistant", "bad"), (1, 3, "user", "more"), (1, 4, "assistant", "same")])
    rows = p.preference_pairs(chosen, rejected).collect()
    assert render(rows, 1, "prompt") == ("<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nq<|im_end|>\n", [False, False])
    text, trained = render(rows, 1, "chosen")
    assert text.startswith("<|im_start|>assistant\ngood<|im_end|>\n") and trained == [True, False, True]
    assert render(rows, 1, "rejected")[0] == text.replace("good", "bad")


def test_odd_rows(spark):
    chosen = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, None, None), (2, 0, "user", "only"), (3, 0, "user", "x"), (None, 0, "user", "n"), (4, None, "user", "n")]
    rejected = [(1, 0, "user", "a"), (1, 1, None, ""), (3, 0, "user", "x"), (5, 0, "assistant", "lonely")]
    rows = p.preference_pairs(turns(spark, chosen).selectExpr("*", "1 AS section"), turns(spark, rejected)).collect()
    assert render(rows, 1, "prompt")[0].count("im_start") == 1
    assert render(rows, 1, "chosen") == render(rows, 1, "rejected") == ("<|im_start|>unknown\n<|im_end|>\n", [False])
    assert render(rows, 2, "chosen")[1] == [False] and render(rows, 2, "prompt")[0] == ""
    assert render(rows, 3, "prompt")[0] and not render(rows, 3, "chosen")[0]
    assert render(rows, 5, "rejected")[1] == [True]
    assert {r["pair_id"] for r in rows} == {1, 2, 3, 5}
    empty = turns(spark, [])
    assert p.preference_pairs(empty, p.degraded(empty)).collect() == []


def test_empty_and_very_long_conversations(spark):
    long = [(1, i, ("user", "assistant")[i % 2], "w " * 50_000 if i == 0 else f"t{i}") for i in range(400)]
    chosen = turns(spark, [*long, (2, 0, "user", ""), (2, 1, "assistant", "")])
    rejected = turns(spark, [*long[:-1], (1, 399, "assistant", "other"), (2, 0, "user", "")])
    rows = p.preference_pairs(chosen, rejected).collect()
    text, trained = render(rows, 1, "prompt")
    assert text.count("<|im_start|>") == 399 and not any(trained) and "w " * 50_000 in text
    assert render(rows, 1, "rejected")[0] == "<|im_start|>assistant\nother<|im_end|>\n"
    assert render(rows, 2, "chosen") == ("<|im_start|>assistant\n<|im_end|>\n", [True]) and render(rows, 2, "rejected")[0] == ""


def test_query_equals_its_sql(spark, tables_dir, duck):
    from arrears.llm import queries

    found = queries.op1_preference_formatting(spark, tables_dir)
    names = ", ".join(found.columns)
    expected = duck.sql(f"SELECT {names} FROM ({p.ORACLE})").fetchall()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
