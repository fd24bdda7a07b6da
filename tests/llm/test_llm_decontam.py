from __future__ import annotations

import pyarrow as pa
from llm_data import documents, frame

from trackframe.llm.decontam import NAME, NUMBER, UNIT, WORD, contaminated, tokens
from trackframe.llm.textops import utf8

ITEMS = [(1, "A train leaves Paris with 120 people and after Lyon it has 45 people more than before; Anna counts 120 seats of 3 kg each."),
         (2, "How many apples does the old farmer sell on every market day of the month?"), (3, None), (4, ""), (5, "1 2 3 4 5 6 7"), (2, "Short one here")]


def test_finds_verbatim_and_changed_items(spark):
    rows = documents()
    text = ITEMS[0][1]
    changed = text.replace("120", "75").replace("45", "31").replace("Paris", "Berlin").replace("Lyon", "Bonn").replace("Anna", "Mary").replace("3 kg", "9 lb")
    torn = text.replace("120 people", "75 people").replace("45", "31").replace("120 seats", "99 seats").replace("3 kg", "75 kg")
    rows += [(500, "Some words before. " + text + " And after.", None, None, None), (501, changed.upper() + " x", None, None, None),
             (502, "lead. " + changed, None, None, None), (503, ITEMS[1][1].replace("farmer", "baker").replace("market", "work").replace("apples", "rolls"), None, None, None),
             (504, torn, None, None, None), (505, text + " " + text, None, None, None), (506, "numbers 9 8 7 6 5 4 3", None, None, None),
             (507, "x 1 2 3 4 5 6 7 y", None, None, None), (508, "how many apples does THE old farmer sell, on every market day of the month", None, None, None)]
    got = {(r["doc_id"], r["item_id"]): r for r in contaminated(frame(spark, rows), spark.createDataFrame(ITEMS, "item_id long, text string")).collect()}
    assert set(got) == {(500, 1), (502, 1), (505, 1), (507, 5), (508, 2)}
    assert got[502, 1]["changed"] and not got[500, 1]["changed"] and got[500, 1]["coverage"] > 0.9


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contaminated(frame(spark, []), items).count() == 0
    assert contaminated(frame(spark, extra=True), items.where("false")).count() == 0


def test_names_that_open_sentences(spark):
    item = "Tom has 5 apples. Anna gives Tom 3 more apples. How many apples does Tom have now?"
    swap = lambda a, b: item.replace("Tom", a).replace("Anna", b)
    texts = [swap("Bob", "Eve"), "He said: " + swap("Bob", "Eve").replace("5", "8"), "x. " + swap("Bob", "Eve").replace(". How", "; how"), item,
             swap("Bob", "Eve").replace("does Bob", "does Sam").replace("gives Bob", "gives Jim"), swap("Bob", "Eve").replace("apples", "cherries")]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in contaminated(frame(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert set(got) == {0, 1, 2, 3}
    assert got[0]["coverage"] == got[2]["coverage"] == 1 and got[0]["n_windows"] == 13 and got[0]["changed"] and not got[3]["changed"]


def test_short_items_inside_longer_texts(spark):
    items = [(1, "capital of France?"), (2, "forty two"), (3, "why")]
    texts = ["say the capital of Spain or so, please", "capital of Italy", "the answer is forty two of course", "but why", "why", "capital city of France now", "forty one or two"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = {(r["doc_id"], r["item_id"]): r["changed"] for r in contaminated(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(0, 1): True, (1, 1): True, (2, 2): False, (3, 3): False, (4, 3): False}


def test_other_ways_to_write_numbers_and_names(spark):
    item = "Tom has five apples and gives three of them to Anna before lunch. How many apples does Tom still have?"

    def swap(*pairs: tuple[str, str]) -> str:
        text = item
        for old, new in pairs:
            text = text.replace(old, new)
        return text

    found = [swap(("five", "twelve"), ("three", "four")), swap(("five", "5"), ("three", "3")), swap(("five", "9"), ("three", "twenty-two")),
             swap(("Tom", "Олег"), ("Anna", "Žofie")), swap(("Tom", "TOM"), ("Anna", "ANNA")), swap(("Tom", "Mary Ann"), ("Anna", "Peter van Dyk".title())),
             swap(("Tom", "Élodie"), ("Anna", "Ömer")), "In class: " + item]
    missed = [swap(("apples does Tom", "apples does Bob"), ("gives three", "gives Bob three")).replace("Anna", "Bob"),
              swap(("apples", "pears"), ("gives", "sells"), ("lunch", "dawn")), "tom has five apples"]
    rows = [(i, t, None, None, None) for i, t in enumerate(found + missed)]
    got = {r["doc_id"]: r for r in contaminated(frame(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert set(got) == set(range(len(found)))
    assert got[0]["changed"] and not got[1]["changed"] and not got[7]["changed"]


def test_tokens_of_any_script():
    texts = ["Twenty-five km, ЖЁЛТЫЙ дом. Mary Ann Smith paid 3,500 euros", "", "ID 5 five \u0665", "x"]
    kind, value, place, bounds, either = tokens(*utf8(pa.array(texts)))
    part = lambda x, i: x[bounds[i]:bounds[i + 1]].tolist()
    assert part(kind, 0) == [NUMBER, UNIT, WORD, WORD, NAME, WORD, NUMBER, UNIT]
    assert part(either, 0) == [False, False, True] + [False] * 5 and not part(kind, 1) and part(kind, 2) == [WORD, NUMBER, NUMBER, NUMBER]
    assert part(value, 2)[1] == part(value, 2)[2] and part(kind, 3) == [WORD]
