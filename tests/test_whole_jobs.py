"""Queries that run where their SQL cannot say the same, against brute force on small tables."""

import re

import pytest

import corvane.plans.functions_sql as functions_sql
import corvane.plans.relations_sql as relations_sql

NAMES = ["Zoncatal", "Zoncatal, Inc.", "Zoncatal, Orrery, Ltd.", " Zoncatal", "Austin-based Zoncatal", "Acme, Dallas-based Zoncatal, Inc.", "Acme, Fort Worth–based Zoncatal", "Zoncatal, housed at Greentown Labs", "Zoncatal Housed at Labs. Two, Inc.", "housed", "Zoncatal which, that is", ",", "", None]


def list_item(text):
    """The parts of a list item, step by step."""
    s = text.strip(" ")
    if len(s) < 5 or s.endswith(("›", ">")):
        return None, None, None
    place = None
    if m := re.match(r"(?:[A-Z][^,]+,\s+)?[A-Z][a-z][\w\s]*[-–]based\s+", s):
        place, s = re.sub("[-–]based$", "", m.group().strip()), s[m.end() :]
    s = re.sub(r",?\s+housed at [^,.]+", "", s, flags=re.I).strip(" ")
    item, _, about = s.partition(",")
    about = about.strip(" ")
    while about.startswith(("which ", "that ", "is ")):
        about = about.partition(" ")[2]
    return item.strip(" ") or None, about.strip(" ") and about or None, place


def test_list_items_of_all_companies(spark, tmp_path):
    rows = [(f"c{i}", n, s) for i, (n, s) in enumerate((n, s) for n in NAMES for s in ("hydrogen", None))]
    spark.createDataFrame(rows, "id string, name string, sub_sector string").write.parquet(f"{tmp_path}/companies.parquet")
    out = {r.id: (r.item, r.about, r.place) for r in functions_sql.QUERIES["sv_f16_all_items"](spark, str(tmp_path)).collect()}
    want = {i: (None, None, None) if n is None else list_item(f"Houston-based {n}, which {s or ''}") for i, n, s in rows}
    assert out == want


@pytest.mark.parametrize("name", ["sv_f16_all_items"])
def test_every_row_is_there(spark, data, name):
    assert functions_sql.QUERIES[name](spark, data).count() == spark.read.parquet(f"{data}/companies.parquet").count()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def test_distance_of_whole_names(spark, tmp_path):
    names = ["Åsvik Énergie", "Asvik Energie", "svik nergie", "Éze", "Èze", "水素 Power", "水力 Power", "𝔸cme Ω", "acme  ω", "É", "", None]
    spark.createDataFrame([(f"c{i}", n) for i, n in enumerate(names)], "id string, name string").write.parquet(f"{tmp_path}/companies.parquet")
    pairs = [(i * 100 + j, f"c{i}", f"c{j}") for i in range(len(names)) for j in range(len(names))]
    spark.createDataFrame(pairs, "pair_id long, left_id string, right_id string").write.parquet(f"{tmp_path}/match_pairs.parquet")
    out = {r.pair_id: (r.t, r.d) for r in relations_sql.QUERIES["sv_f38_whole_distance"](spark, str(tmp_path)).collect()}
    low = [n if n is None else n.lower().strip(" ") for n in names]
    tokens = [n if n is None else " ".join(sorted(re.split(r"\s+", n))) for n in low]
    want = {k: (tokens[k // 100], None if None in (low[k // 100], low[k % 100]) else distance(low[k // 100], low[k % 100])) for k, _, _ in pairs}
    assert out == want and out[304][1] == 1


def test_words_of_whole_texts(spark, tmp_path):
    texts = ["x" * 150 + " the Grid", "wind " + "x" * 200, "x" * 97 + "carbon", "nothing" * 40, "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.v for r in functions_sql.QUERIES["sv_p01_text_words"](spark, str(tmp_path)).collect()} == {0: 1, 1: 1, 2: 1, 3: 0, 4: 0, 5: 0}
