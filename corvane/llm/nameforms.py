"""Parsing of typed company and person names: folding, tokens, general words learned from the corpus, name classes."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.scratch import Scratch

#: Letters that have no decomposition.
SPECIAL = str.maketrans({"ø": "o", "ß": "ss", "ł": "l", "æ": "ae", "œ": "oe", "đ": "d", "ð": "d", "þ": "th", "ı": "i"})
#: Legal forms and articles, kinds of organisation, Roman numerals of vehicles, chemical short forms.
LEGAL = frozenset("the inc llc ltd corp co company pbc holdings holding lp llp plc gmbh limited incorporated corporation group us usa uk".split())
KINDS = ("manufacturing", "industries", "technologies", "solutions", "systems", "laboratories", "international", "services", "partners", "ventures")
NUMERALS = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10}
SYNONYMS = {"h2": "hydrogen", "h2o": "water", "mfg": "manufacturing"}
TITLES = frozenset("dr prof mr mrs ms phd ceo cto cfo coo md mba jr sr founder".split())
#: Short and variant forms of given names that stand for one name only. A default, beside what is learned.
SHORT_NAMES = """bill william|will william|bob robert|bobby robert|rob robert|mike michael|mick michael|tony anthony|ted theodore|theo theodore|joe joseph|jos joseph
ben benjamin|beth elizabeth|liz elizabeth|eliza elizabeth|kate katherine|kathy katherine|catherine katherine|peggy margaret|maggie margaret|jenny jennifer|jen jennifer
chris christopher|kit christopher|ed edward|ned edward|eddie edward|steve stephen|steven stephen|nate nathaniel|nathan nathaniel|sue susannah|susanna susannah
deb deborah|debra deborah|geoff geoffrey|jeffrey geoffrey|vicky victoria|tori victoria|dima dmitri|dmitry dmitri|paco francisco|pepe jose|gaby gabriela
mohamed mohammed|muhammad mohammed|mohd mohammed|yousef yusuf|yousuf yusuf|joerg jorg|soeren soren|sam samantha|alex alexander"""

PARENS = re.compile(r"\([^)]*\)")
ALIAS = re.compile(r"\s(?:d/b/a|dba|a/k/a|aka|formerly)\s.*$")
DOTTED = re.compile(r"\b(?:[a-z]\.){2,}")
TOKEN = re.compile(r"[a-z0-9]+")


def fold(text: str) -> str:
    """Lower-case without accents."""
    text = unicodedata.normalize("NFKD", text.lower().translate(SPECIAL))
    return "".join(c for c in text if not unicodedata.combining(c)) if not text.isascii() else text


def company_tokens(name: str) -> list[str]:
    s = ALIAS.sub("", PARENS.sub(" ", fold(name)))
    s = DOTTED.sub(lambda m: m.group().replace(".", "") + " ", s.replace("'", "").replace("’", ""))
    return TOKEN.findall(s)


def person_tokens(name: str) -> tuple[list[str], list[str]]:
    """Given names and surname as tokens; the surname is before the comma, else last."""
    s = PARENS.sub(" ", fold(name)).replace("'", "").replace("’", "")
    parts = [[t for t in TOKEN.findall(p) if t not in TITLES] for p in s.split(",")]
    parts = [p for p in parts if p]
    if len(parts) > 1:
        return [t for p in parts[1:] for t in p], parts[0]
    tokens = parts[0] if parts else []
    return tokens[:-1], tokens[-1:]


def abbreviates(short: str, word: str) -> int:
    """How well ``short`` abbreviates ``word``: 2 a prefix, 1 letters in order from the first, 0 not at all."""
    if len(short) < 2 or len(short) >= len(word) or short[0] != word[0]:
        return 0
    if word.startswith(short):
        return 2
    it = iter(word)
    return int(all(c in it for c in short))


def edits(a: str, b: str, most: int = 3) -> int:
    """Optimal string alignment distance (insert, delete, replace, swap neighbours), at most ``most`` + 1."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return row[-1]


SOUNDS = ((re.compile("ph"), "f"), (re.compile("qu"), "kw"), (re.compile("x"), "ks"), (re.compile("sch"), "sh"), (re.compile("ck|q"), "k"), (re.compile("c(?!h)"), "k"), (re.compile("z"), "s"), (re.compile("y"), "i"), (re.compile("w"), "v"), (re.compile(r"(.)\1"), r"\1"))


@lru_cache(maxsize=100_000)
def sound(word: str) -> str:
    """A word with spellings that sound alike made equal."""
    for pattern, to in SOUNDS:
        word = pattern.sub(to, word)
    return word


def skeleton(word: str) -> str:
    return word[0] + "".join(c for c in word[1:] if c not in "aeiou")


def without(word: str, letters: int) -> set[str]:
    """The word without up to ``letters`` of its letters."""
    forms = {word}
    for _ in range(letters):
        forms |= {f[:i] + f[i + 1 :] for f in forms for i in range(len(f))}
    return forms


class Nearby:
    """Words few slips away: two words that are ``most`` slips apart share a form without up to ``most`` letters."""

    def __init__(self, words: Iterable[str], most: int):
        self.most = most
        self.forms: dict[str, list[str]] = {}
        for w in words:
            for f in without(w, most):
                self.forms.setdefault(f, []).append(w)

    def of(self, word: str) -> list[tuple[int, str]]:
        """(slips, word) of all words at most ``most`` slips away, itself included."""
        met = {w for f in without(word, self.most) for w in self.forms.get(f, ())}
        return [(d, w) for w in met if (d := edits(word, w, self.most)) <= self.most]


#: A vocabulary goes to every Python worker: it is refused beyond this size. Languages have fewer general words and given names.
MOST_WORDS = 500_000


class Vocabulary:
    """General words of company names, given-name classes of persons. Built by the functions below from all names. Where the
    general words come with the number of names they are in, one that is a slip of a much more frequent one is no word of
    its own. ``kinds`` (kinds of organisation, which are no line of business) and ``synonyms`` are parameters."""

    def __init__(self, general: set[str] | dict[str, int], given: dict[str, str], kinds: tuple[str, ...] = KINDS, synonyms: dict[str, str] = SYNONYMS):
        if len(general) > MOST_WORDS or len(given) > MOST_WORDS:
            raise ValueError("no vocabulary: too many general words or given names")
        self.kinds, self.synonyms = frozenset(kinds), synonyms
        self.general = {w for w in general if w not in LEGAL and w not in NUMERALS and len(w) > 2}
        words = self.general | self.kinds
        starts = self._by_start(sorted(words), 1)
        longer = Nearby(words, 1)
        starts4 = self._by_start(sorted(words), 4)
        counts = general if isinstance(general, dict) else {}
        heavy = lambda v, w: counts.get(v, 0) >= 8 * counts.get(w, 0) > 0
        slips = {w for w in words if len(w) >= 6 and any(heavy(v, w) and len(v) >= 6 and edits(w, v, 2) <= 2 for v in starts4[w[:4]])}
        short = {w for w in words if w in slips or w[:-1] + "ies" in words - {w} or any(abbreviates(w, v) for v in starts[w[0]]) or (len(w) >= 5 and any(len(v) > len(w) for _, v in longer.of(w)))}
        self.words = sorted(words - short, key=lambda w: (-len(w), w))
        self.known = frozenset(self.words)
        self.starts, self.starts4, self.one = self._by_start(self.words, 1), self._by_start(self.words, 4), Nearby(self.words, 1)
        self.lines = frozenset(w for w in self.words if w not in self.kinds)
        self.given = given
        self.near_given = Nearby((g for g in given if len(g) >= 3), 2)
        self._full: dict[str, str | None] = {}

    @staticmethod
    def _by_start(words: list[str], letters: int) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for w in words:
            out.setdefault(w[:letters], []).append(w)
        return out

    def full_word(self, token: str) -> str | None:
        """The general word that a token is, abbreviates or mistypes."""
        if token not in self._full:
            if len(self._full) > 300_000:
                self._full.clear()
            self._full[token] = self._find(token)
        return self._full[token]

    def _find(self, token: str) -> str | None:
        if token in self.synonyms:
            return self.synonyms[token]
        known = token in self.general
        if token in self.kinds or (known and token in self.known):
            return token
        if token[:-1] + "ies" in self.known:
            return token[:-1] + "ies"
        alike = self.starts.get(token[0], [])
        ranked = max(((abbreviates(token, w), -abs(len(w) - len(token)), w) for w in alike), default=(0, 0, ""))
        if ranked[0] == 2 and len(token) >= 3:
            return ranked[2]
        near = min((x for x in self.one.of(token) if len(x[1]) >= 5 and x[1][0] == token[0]), default=None) if len(token) >= 4 else None
        if near:
            return near[1]
        if ranked[0] == 1:
            fits = [v for v in alike if abbreviates(token, v) and (known or token == skeleton(v) or (len(token) >= 4 and token[-1] == v[-1] and len(token) / len(v) >= 0.6))]
            if fits:
                return min(fits, key=lambda v: (len(v), v))
            if known:
                return ranked[2]
        if len(token) >= 6:
            for w in self.starts4.get(token[:4], []):
                if len(w) >= 6 and edits(token, w, 2) <= 2:
                    return w
        return token if known else None

    def line_at_end(self, word: str) -> str | None:
        """The longest line of business, of four letters or more, that ends a word and leaves at least four letters."""
        return next((word[-k:] for k in range(len(word) - 4, 3, -1) if word[-k:] in self.lines), None)

    def company(self, name: str) -> tuple[str, str, str, int]:
        """(own part, first line of business, all lines, numeral); numeral 0 if there is none."""
        tokens = company_tokens(name)
        own, lines, number = [], [], 0
        strange = [t for t in tokens if t not in LEGAL and t not in NUMERALS and t not in self.general and t not in self.kinds]
        longest = max(strange, key=len, default="")
        i = 0
        while i < len(tokens):
            t = tokens[i]
            pair = t + tokens[i + 1] if i + 1 < len(tokens) else ""
            if len(pair) > 5 and pair in self.known and t not in self.known:
                t, i = pair, i + 1
            i += 1
            if t in LEGAL:
                continue
            if t in NUMERALS and (own or lines):
                number = NUMERALS[t]
                continue
            full = None if t == longest and len(strange) > 0 and self._own(t, strange) else self.full_word(t)
            if full is None:
                own.append(t)
            elif full not in self.kinds:
                lines.append(full)
        word = "".join(own)
        if not lines:
            while found := self.line_at_end(word):
                word, lines = word[: -len(found)], [found, *lines]
        if not word:
            word, lines = "".join(tokens), []
        return word, lines[0] if lines else "", " ".join(sorted(set(lines))), number

    def _own(self, token: str, strange: list[str]) -> bool:
        """The longest strange token is the name's own part, unless it is nearly a general word."""
        full = self.full_word(token)
        return full is None or (len(strange) == 1 or edits(token, full, 1) > 1)

    def person(self, name: str) -> tuple[str, str, str]:
        """(surname, class of the given name, initial). The class is empty where only an initial is known."""
        given, last = person_tokens(name)
        if given and len(given) == 1 and last and last[0] in self.given and given[0] not in self.given and len(given[0]) > 2 and "," not in name:
            given, last = last, given
        surname = "".join(last)
        if not given:
            return surname, "", ""
        whole = "".join(given[:2])
        first = whole if len(given) > 1 and whole in self.given else given[0]
        if len(first) == 1 or (len(first) == 2 and first not in self.given and "." in name):
            return surname, "", first[0]
        return surname, self.given_class(first), first[0]

    @lru_cache(maxsize=100_000)  # noqa: B019
    def given_class(self, first: str) -> str:
        if first in self.given:
            return self.given[first]
        near = sorted((d, -len(g), g) for d, g in self.near_given.of(first))
        if near and near[0][0] <= (1 if len(first) < 7 else 2):
            return self.given[near[0][2]]
        return first


def general_words(tokens: DataFrame, least: int = 8, rarer: int = 2, joined: float = 0.25) -> dict[str, int]:
    """Tokens that go with many different rarer tokens, and the names they are in, from ``tokens(name, token, before, after)`` over all distinct names, a
    row for each different token of a name, with its neighbours in the name.

    A token is general if at least ``least`` different tokens, each in at most 1 / ``rarer`` as many names as itself, go with
    it, and if it is no piece of words that are sometimes written in two: what it makes with its different neighbours is a
    token in less than ``joined`` of the cases, and is not, in half of its names, a token more frequent than itself. All of
    this looks at the names that hold the token only, so names without it have no influence, however many there are."""
    tokens = Scratch(tokens.sparkSession).keep(tokens)
    df = Scratch(tokens.sparkSession).keep(tokens.groupBy("token").agg(F.count("*").alias("df")))
    often = df.where(F.col("df") >= least)
    here = tokens.select("name", "token").join(often, "token")
    with_ = tokens.select("name", F.col("token").alias("other"))
    pairs = here.hint("merge").join(with_, "name").where("token <> other").select("token", "df", "other").distinct()
    rare = pairs.join(df.select(F.col("token").alias("other"), F.col("df").alias("odf")), "other").where(F.col("odf") * rarer <= F.col("df"))
    many = Scratch(tokens.sparkSession).keep(rare.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("token"))
    both = F.array_compact(F.array(F.concat("before", "token"), F.concat("token", "after")))
    beside = tokens.join(many, "token", "left_semi").select("token", F.explode(both).alias("both")).groupBy("token", "both").agg(F.count("*").alias("k"))
    beside = beside.join(df.select(F.col("token").alias("both"), F.col("df").alias("whole")), "both", "left").join(df, "token")
    pieces = beside.groupBy("token").agg((F.count("whole") / F.count("*")).alias("kinds"), F.sum(F.when(F.col("whole") >= F.col("df"), F.col("k") / F.col("df"))).alias("names"))
    pieces = pieces.where((F.col("kinds") >= joined) | (F.col("names") >= 0.5))
    words = many.join(pieces, "token", "left_anti").join(df, "token")
    return {r.token: r.df for r in words.limit(MOST_WORDS + 1).collect()}


def given_classes(people: DataFrame, least: int = 6, share: float = 0.1, heavier: int = 8, short_names: str = SHORT_NAMES) -> dict[str, str]:
    """Given names to classes of names that stand for one another, from ``people(given, surname, company_id)``.

    A given name goes with at least ``least`` surnames. Two are one if they meet under the same surname at the same company:
    under two surnames or more, and in at least ``share`` of the places where the rarer of both meets any other given name.
    ``short_names`` (pairs) are one besides. What is one with no other, and a slip of a name that goes with ``heavier`` times
    as many surnames, is no given name of its own.
    Only places where a name occurs count, so other people have no influence, however many there are."""
    scratch = Scratch(people.sparkSession)
    seen = scratch.keep(people.where(F.length("given") > 1).select("given", "surname", "company_id").distinct())
    often = seen.groupBy("given").agg(F.count_distinct("surname").alias("n")).where(F.col("n") >= least)
    counts = {r.given: r.n for r in often.limit(MOST_WORDS + 1).collect()}
    if len(counts) > MOST_WORDS:
        raise ValueError("no vocabulary: too many given names")
    near = Nearby(counts, 2)
    slips = {g for g in counts if any(counts[h] >= heavier * counts[g] and d <= (1 if len(g) < 7 else 2) for d, h in near.of(g))}
    parent: dict[str, str] = {g: g for g in counts}

    def root(x: str) -> str:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for pair in short_names.replace("\n", "|").split("|") if short_names else []:
        a, b = pair.split()
        parent[root(a)] = root(b)
    if counts:
        shared = scratch.keep(seen.join(seen.groupBy("surname", "company_id").agg(F.count("*").alias("k")).where("k > 1").select("surname", "company_id"), ["surname", "company_id"], "left_semi"))
        known = shared.join(seen.sparkSession.createDataFrame([(g,) for g in counts], "given string"), "given", "left_semi")
        places = {r.given: r.n for r in known.groupBy("given").agg(F.count("*").alias("n")).collect()}
        a, b = known.select(F.col("given").alias("a"), "surname", "company_id"), known.select(F.col("given").alias("b"), "surname", "company_id")
        met = a.hint("merge").join(b, ["surname", "company_id"]).where("a < b").groupBy("a", "b").agg(F.count_distinct("surname").alias("n"), F.count("*").alias("k")).where("n >= 2")
        for r in sorted(met.collect(), key=lambda r: (-r.k, r.a, r.b)):
            if r.k >= share * min(places[r.a], places[r.b]):
                x, y = root(r.a), root(r.b)
                if x != y:
                    parent[min((x, y), key=lambda g: (counts.get(g, 0), g))] = max((x, y), key=lambda g: (counts.get(g, 0), g))
    classes = {g: root(g) for g in parent}
    sizes = Counter(classes.values())
    return {g: c for g, c in classes.items() if g not in slips or sizes[c] > 1}
