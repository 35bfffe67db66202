"""Leaks against brute force."""

import random
import re

from corvane.llm.leakage import Leaks

WORDS = "alpha beta gamma delta rule shows for under the of record line day".split()


def grams(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + 13]) for i in range(len(w) - 12)}


def make(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choice(WORDS) if rng.random() < 0.8 else f"Name{rng.randrange(40)}" for _ in range(rng.choice([8, 20, 40])))) for i in range(25)]
    docs = []
    for d in range(60):
        words = [rng.choice(WORDS) for _ in range(30)]
        if d % 3 == 0:
            own = items[rng.randrange(25)][1].split()
            k = rng.randrange(10, 16)
            at = rng.randrange(max(1, len(own) - k))
            words[10:10] = own[at : at + k]
        docs.append((d, ("-- ".join(words) if d % 2 else " ".join(words).upper())))
    return items, docs + [(900, None), (901, ""), (902, "alpha " * 50_000), docs[0]]


def test_verbatim(spark):
    items, docs = make(4)
    items += [(98, None), (99, "short")]
    d, i = spark.createDataFrame([(*x, "e") for x in docs], "doc_id long, text string, item_id string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(a, b) for a, t in docs for b, s in items if grams(t) & grams(s)}
    assert want
    assert {tuple(r) for r in Leaks(d, i).verbatim().collect()} == want
    assert {tuple(r) for r in Leaks(d, i, filter_bound=1).verbatim().collect()} == want


def test_empty(spark):
    d, i = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert Leaks(d, i).verbatim().count() == 0 and Leaks(d, i).reparameterised().count() == 0


def test_reparameterised(spark):
    base = "in docket {} {} the rater from {} scored a claim worth {} points because the patent had lapsed at {} on day {} for {}"
    items = [(k, base.format(f"Aa{x}", k + 10, f"Bb{x}", k + 500, f"Cc{x}", k + 90, f"Dd{x}")) for k, x in enumerate("vwxyz")]
    docs = [(1, base.format("Zed", 77, "Yes", 78, "Xen", 79, "Wen")), (2, base.format("Zed", 77, "Zed", 78, "Xen", 79, "Wen")), (3, items[0][1])]
    out = Leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).reparameterised()
    got = {(r.doc_id, r.item_id) for r in out.collect()}
    assert {(1, k) for k in range(5)} <= got and not any(d == 2 for d, _ in got) and (3, 0) not in got


def test_planted_changes_are_found(spark):
    """Questions with other names and numbers inside longer texts: nine in ten are found, and no text without one."""
    import random

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(4))
    frames = [
        "a tank of {n} holds {a} litres of brine and drains by {b} litres an hour so how many hours does {m} wait until the tank is empty",
        "the pump at {n} lifts {a} litres in {b} minutes and the owner {m} asks how long it takes to lift twice as much water to the same height",
        "when {n} sells {a} panels at a price of {b} and {m} buys half of them what is the sum that is paid in the end by both",
    ]
    fill = lambda t: t.format(n=word(), m=word(), a=rng.randrange(100, 999), b=rng.randrange(10, 99))
    items = [(i, fill(frames[i % 3])) for i in range(60)]
    docs, want = [], set()
    for d in range(120):
        noise = lambda: " ".join(word() for _ in range(30))
        docs.append((d, f"{noise()}. {fill(frames[d % 3])} {noise()}" if d % 2 else noise()))
        if d % 2:
            want.add(d)
    leaks = Leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = {r.doc_id for r in leaks.reparameterised().collect()}
    assert len(found & want) / len(want) >= 0.9 and found <= want
