"""Names: parsing, MinHash recall, star clusters, verification."""

import random

import numpy as np
import pytest

from corvane.llm.nameforms import Nearby, Vocabulary, edits, fold, general_words, given_classes, person_tokens, sound
from corvane.llm.q_variants import QUERIES, company_entities, company_vocabulary
from corvane.llm.variants import Banding, MinHash, bands_for, candidate_pairs, entities, monge_elkan, qgrams, spelling_pairs, star_clusters, verify
from corvane.scratch import Scratch

V = Vocabulary({"hydrogen", "carbon", "capture", "geothermal", "power", "storage", "inc", "ii"}, {"theodore": "theodore", "ted": "theodore", "maria": "maria"})


@pytest.mark.parametrize(
    "name,want",
    [
        ("acmerol hydrogen systems, inc.", ("acmerol", "hydrogen", 0)), ("the acmerol h2 sys. l.l.c.", ("acmerol", "hydrogen", 0)), ("carbon capture technologies, acmerol co.", ("acmerol", "carbon", 0)),
        ("acme-rol geo-thermal", ("acmerol", "geothermal", 0)), ("acmerolstorage", ("acmerol", "storage", 0)), ("acmerol pwr ii lp", ("acmerol", "power", 2)), ("ácmérol strge (web)", ("acmerol", "storage", 0)), ("acmerol", ("acmerol", "", 0)), ("", ("", "", 0)),
    ],
)
def test_companies(name, want):
    own, line, _, number = V.company(name)
    assert (own, line, number) == want


@pytest.mark.parametrize("name,want", [("ted smithers", ("smithers", "theodore", "t")), ("smithers, theodore", ("smithers", "theodore", "t")), ("dr. theodore q. smithers (ceo)", ("smithers", "theodore", "t")), ("t. smithers", ("smithers", "", "t")), ("smithers, t.q.", ("smithers", "", "t")), ("smithers ted", ("smithers", "theodore", "t")), ("theodroe smithers", ("smithers", "theodore", "t")), ("smithers", ("smithers", "", "")), ("", ("", "", ""))])
def test_people(name, want):
    assert V.person(name) == want


def test_edits_and_sounds():
    assert edits("abcd", "abdc") == 1 and edits("abc", "abc") == 0 and edits("abc", "xyzw", 2) == 3
    assert sound("chophreput") == sound("chofreput") and sound("brascoshort") == sound("braskoshort") and fold("Søren É") == "soren e"
    assert person_tokens("smith, phd") == ([], ["smith"])


def test_minhash_meets_its_curve():
    rng = random.Random(1)
    rows, similar, recall = 4, 0.45, 0.95
    mh = MinHash(rows, bands_for(similar, rows, recall), 3)
    words = ["".join(rng.choices("bcdfghklmnprstvw", k=4)) + "".join(rng.choices("aeiouxyz", k=5)) for _ in range(400)]
    swapped = [w[:4] + w[5] + w[4] + w[6:] for w in words]
    a, b = mh.keys(words), mh.keys(swapped)
    sims = [len(set(qgrams(x, 3)) & set(qgrams(y, 3))) / len(set(qgrams(x, 3)) | set(qgrams(y, 3))) for x, y in zip(words, swapped)]
    hit = [bool(np.intersect1d(x, y).size) for x, y in zip(a, b)]
    good = [h for h, s in zip(hit, sims) if s >= similar]
    assert len(good) > 300 and sum(good) / len(good) >= recall - 0.02
    far = mh.keys(["".join(rng.choices("abcdefghij", k=9)) for _ in range(300)])
    assert np.mean([bool(np.intersect1d(far[i], far[i + 1]).size) for i in range(0, 298)]) < 0.05


def test_every_slip_is_a_candidate(spark):
    rng = random.Random(3)
    words, slips = [], []
    for n in (4, 5, 6, 7, 8, 9):
        for kind in range(4):
            for _ in range(25):
                w = "".join(rng.sample("abcdefghiklmnoprstuvwxyz", n))
                i = rng.randrange(n - 1)
                words.append(w)
                slips.append([w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + "q" + w[i + 1 :], w[:i] + "q" + w[i:], (w + "q")[: i + 1] + w[i + 1 :] + "j"][kind])
    rows = [(2 * k + j, (w, v)[j], f"c{k}") for k, (w, v) in enumerate(zip(words, slips)) for j in (0, 1)]
    found = {tuple(r) for r in candidate_pairs(spark.createDataFrame(rows, "node long, own string, class string")).collect()}
    assert found == {(2 * k, 2 * k + 1) for k in range(len(words))}


@pytest.mark.parametrize("letters", range(4, 13))
def test_bands_alone_find_every_length(letters):
    rng = random.Random(letters)
    banding = Banding()
    words = ["".join(rng.sample("abcdefghiklmnoprstuvwyz", letters)) for _ in range(600)]
    at = [rng.randrange(letters - 1) for _ in words]
    kinds = {
        "swap": [w[:i] + w[i + 1] + w[i] + w[i + 2 :] for w, i in zip(words, at)], "replace": [w[:i] + "q" + w[i + 1 :] for w, i in zip(words, at)],
        "insert": [w[:i] + "q" + w[i:] for w, i in zip(words, at)],
    }
    sets = lambda ws: [set(k) for k in map(list, _by_word(banding, ws))]
    own = sets(words)
    for kind, slips in kinds.items():
        assert np.mean([bool(a & b) for a, b in zip(own, sets(slips))]) >= 0.95, kind


def _by_word(banding, words):
    out = [[] for _ in words]
    for i, k in zip(*banding.keys(words)):
        out[i].append(int(k))
    return out


def test_other_rows_do_not_change_the_general_words(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(4)) + rng.choice("xnl")
    own = [word() for _ in range(120)]
    names = [f"{o} {line} inc" for o in own for line in rng.sample(["hydrogen", "storage", "geothermal", "offshore"], 2)] + [f"{o} off shore" for o in own[:12]]
    split = [f"{o[:5]} {o[5:]} storage" for o in own[:40]]
    learn = lambda ns: company_vocabulary(spark.createDataFrame([(n,) for n in ns], "name string"))
    few = learn(names + split)
    assert set(few) == {"hydrogen", "storage", "geothermal", "offshore", "inc"}
    assert learn(names + split + [f"{word()} {word()}" for _ in range(20_000)]) == few
    assert general_words(spark.createDataFrame([], "name string, token string, before string, after string")) == {}


def test_other_rows_do_not_change_the_pairs(spark, data, tmp_path):
    import pandas as pd

    rng = random.Random(6)
    word = lambda: "".join(rng.choice("cdfghjlmnpqrtvw") + rng.choice("aeiouy") for _ in range(6))
    for t, name in (("companies", "name"), ("founder_company_edges", "founder_name")):
        df = pd.read_parquet(f"{data}/{t}.parquet")
        more = df.sample(4000, replace=True, random_state=1).assign(**{name: [f"zz{word()} zz{word()}" for _ in range(4000)]})
        more["id"] = [f"other-{i}" if t == "companies" else 10**7 + i for i in range(4000)]
        if t == "companies":
            more = more.assign(canonical_domain=[f"{word()}.example" for _ in range(4000)], canonical_id=None)
        else:
            more["company_id"] = [f"other-{i}" for i in range(4000)]
        pd.concat([df, more]).to_parquet(f"{tmp_path}/{t}.parquet")
    q = QUERIES["p4_found"]
    want = {tuple(r) for r in q(spark, data).collect()}
    got = {tuple(r) for r in q(spark, str(tmp_path)).collect()}
    assert {r for r in got if not r[1].startswith("zz") and not r[2].startswith("zz")} == want


def test_words_few_slips_away():
    near = Nearby(["anthony", "maria", "mario"], 2)
    assert sorted(near.of("anthnoy")) == [(1, "anthony")] and sorted(near.of("marie")) == [(1, "maria"), (1, "mario")] and near.of("zzz") == []


def test_slips_of_frequent_words_are_no_words():
    v = Vocabulary({"robotics": 400, "robotix": 12, "sensing": 90, "sensors": 80}, {})
    assert v.company("acmerol robotix")[:2] == ("acmerol", "robotics") and v.company("acmerol sensors")[1] == "sensors"


def _people(spark, tmp_path, edges, companies):
    spark.createDataFrame([(i, n, c) for i, (n, c) in enumerate(edges)], "id long, founder_name string, company_id string").write.parquet(f"{tmp_path}/founder_company_edges.parquet")
    spark.createDataFrame(companies, "id string, name string, canonical_domain string, sub_sector string").write.parquet(f"{tmp_path}/companies.parquet")
    return {tuple(r)[1:] for r in QUERIES["p4_found"](spark, str(tmp_path)).where("entity_kind = 'founder'").collect()}


def test_initials_need_shared_evidence(spark, tmp_path):
    companies = [("c1", "Zoncatal", None, None), ("c2", "zoncatal", None, None), ("c3", "Other", None, None)]
    edges = [("j. smith", "c1"), ("james smith", "c2"), ("john smith", "c3"), ("k. kowaltsu", "c1"), ("karin kowaltsu", "c3"), ("m. jones", "c1"), ("mary jones", "c3"), ("ulrich jones", "c2")]
    assert _people(spark, tmp_path, edges, companies) == {("j. smith", "james smith"), ("k. kowaltsu", "karin kowaltsu")}


def test_candidates_respect_class(spark):
    df = spark.createDataFrame([(1, "acmerol", "x"), (2, "acmeroll", "x"), (3, "acmerol", "y")], "node long, own string, class string")
    assert [tuple(r) for r in candidate_pairs(df).collect()] == [(1, 2)]


def test_verify(spark):
    rows = [(1, 2, "acmerol", "acmrol", "acmerol x", "acmrol x", False), (3, 4, "acmerol", "azzzrol", "acmerol x", "azzzrol x", False), (5, 6, "acmerol", "acmrl", "acmerol", "acmrl", True), (7, 8, "abc", "abd", "abc", "abd", True)]
    out = verify(spark.createDataFrame(rows, "a long, b long, own_a string, own_b string, words_a string, words_b string, supported boolean"), 0.6)
    assert sorted(r.a for r in out.collect()) == [1, 5]
    assert monge_elkan([], ["a"]) == 0 and monge_elkan(["a", "b"], ["b", "a"]) == 1


def test_stars(spark):
    edges = [(1, 2), (1, 3), (1, 4), (4, 5), (6, 7), (3, 1)]
    out = {r.node: r.star for r in star_clusters(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    assert out[1] == out[2] == out[3] == out[4] == 1 and out[6] == out[7] and 5 not in out


def test_pairs(spark):
    names = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", 9), ("a", 1)], "name string, node long")
    links = spark.createDataFrame([(1, 2)], "a long, b long")
    pairs = lambda links: sorted(tuple(r) for r in spelling_pairs(entities(names, links, Scratch(spark))).collect())
    assert pairs(links) == [("a", "b"), ("a", "c"), ("b", "c")] and pairs(links.where("a > 5")) == [("a", "b")]


def test_given_classes_learned(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        g = rng.choice(["aleksandra", "ulrich", "xiaoming"])
        rows.append((g, f"s{i}", f"c{i}"))
        if g == "aleksandra" and i % 3 == 0:
            rows.append(("ola", f"s{i}", f"c{i}"))
    classes = given_classes(spark.createDataFrame(rows, "given string, surname string, company_id string"))
    assert classes["ola"] == classes["aleksandra"] != classes["ulrich"] and classes["bill"] == "william"


def test_a_host_between_others_counts(spark, tmp_path):
    lines = ["hydrogen", "carbon capture", "geothermal", "battery storage"]
    rows = [(f"{w} {line}", f"{w}{k}.com", "x") for k, line in enumerate(lines) for w in ("ordovan", "quillmer", "brastoce", "zumblaph", "tirkelon", "haspindo")]
    rows += [("kelmarint hydrogen", h, "x") for h in ("aaa.com", "mmm.com", "zzz.com")] + [("kelmarnit hydrogen", "mmm.com", "x"), ("kelmarrint hydrogen", "other.com", "x")]
    spark.createDataFrame(rows, "name string, canonical_domain string, sub_sector string").write.parquet(f"{tmp_path}/companies.parquet")
    found = {tuple(r) for r in spelling_pairs(company_entities(spark, str(tmp_path))).collect()}
    assert ("kelmarint hydrogen", "kelmarnit hydrogen") in found and not any("kelmarrint hydrogen" in p for p in found)
