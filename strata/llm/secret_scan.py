"""Secret scan with a trigram inverted index.

Each rule is a regex.  From its syntax a Boolean query over trigrams of lower-cased text is derived that
every match satisfies: literals, small classes, optional parts and alternatives are multiplied out into
the strings that may stand in a row, and all trigrams of one of them must be there; anything else asks
for nothing.  The index holds, for every trigram that some rule asks for, a posting for each document
that has it; a rule's candidates are the documents in the intersection of the postings of one of its
alternatives.  Only candidates are verified with the regex.  A rule whose query asks for nothing (no
mandatory trigram), or whose syntax is not understood, scans every text.

All of it is DataFrame operations.  Postings carry two hashes of id and text, so null and repeated
ids do no harm, and trigrams that most documents have make long postings but no long row:
alternatives are intersected by counting postings a document.
"""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.store import stored


@dataclass(frozen=True)
class Rule:
    kind: str
    #: Java regex; matches are leftmost and don't overlap.
    pattern: str
    #: Matches whose group ``group`` has fewer characters are dropped after they are found.
    least: int = 0
    group: int = 0


#: The base rules, then more kinds by their public formats.
RULES = (
    Rule("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         12, 1),
    # a run of these classes is maximal, so asking for the length in the pattern drops the same matches
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{20,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

#: ASCII letters alone change case, so that every character stays one.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Most strings that parts of a pattern are multiplied out to, most characters of one, and most alternatives of a query.
MOST_STRINGS, MOST_LENGTH, MOST_ALTERNATIVES = 64, 64, 256

#: An OR of ANDs of trigrams; an empty AND asks for nothing.
Query = frozenset[frozenset[str]]
_ANY: Query = frozenset([frozenset()])


def trigrams(word: str) -> frozenset[str]:
    return frozenset(word[i:i + 3] for i in range(len(word) - 2))


def _least(query: Query) -> Query:
    """Without alternatives that ask for more than another one does."""
    return frozenset(a for a in query if not any(b < a for b in query))


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > MOST_ALTERNATIVES:  # either one alone asks for less, so no match is lost
        return min(a, b, key=len)
    return _least(frozenset(x | y for x in a for y in b))


def _strings(words: frozenset[str]) -> Query:
    return _least(frozenset(trigrams(w) for w in words))


def _joined(a: frozenset[str], b: frozenset[str]) -> frozenset[str] | None:
    """All of ``a`` followed by all of ``b``; None if that is too much."""
    if len(a) * len(b) > MOST_STRINGS or max(map(len, a)) + max(map(len, b)) > MOST_LENGTH:
        return None
    return frozenset(x + y for x in a for y in b)


def _class(items) -> frozenset[str] | None:
    """The characters of a class in lower case, if they are few."""
    found = set()
    for kind, value in items:
        name = str(kind)
        if name == "LITERAL":
            found.add(value)
        elif name == "RANGE" and value[1] - value[0] < 2 * MOST_STRINGS:
            found |= set(range(value[0], value[1] + 1))
        else:
            return None
    chars = frozenset(_lowered(chr(c)) for c in found)
    return chars if len(chars) <= MOST_STRINGS else None


def _lowered(text: str) -> str:
    return text.translate(str.maketrans(_UPPER, _LOWER))


def _part(kind: str, value) -> tuple[frozenset[str] | None, Query]:
    """Of one part of a pattern: all strings it matches in lower case, or None; and what it asks for."""
    if kind == "LITERAL":
        return frozenset([_lowered(chr(value))]), _ANY
    if kind == "IN":
        return _class(value), _ANY
    if kind == "AT":  # an anchor matches no characters
        return frozenset([""]), _ANY
    if kind in ("SUBPATTERN", "ATOMIC_GROUP"):
        return _sequence(value[-1] if kind == "SUBPATTERN" else value)
    if kind == "BRANCH":
        each = [_sequence(x) for x in value[1]]
        query = _least(frozenset().union(*[q if words is None else _strings(words) for words, q in each]))
        words = None if any(w is None for w, _ in each) else frozenset().union(*[w for w, _ in each])
        if words is not None and len(words) <= MOST_STRINGS:
            return words, _ANY
        return None, query if len(query) <= MOST_ALTERNATIVES else _ANY
    if kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, inner = value
        words, query = _sequence(inner)
        if words is None or not words:
            return None, query if least else _ANY
        exact, out = frozenset([""]), frozenset([""])
        for k in range(1, int(most) + 1 if int(most) <= MOST_LENGTH else MOST_LENGTH + 1):
            exact = _joined(exact, words)
            if exact is None or len(out | exact) > MOST_STRINGS:
                return None, _strings(words) if least else _ANY
            out = exact if k <= least else out | exact
        return (out, _ANY) if int(most) <= MOST_LENGTH else (None, _strings(words) if least else _ANY)
    return None, _ANY


def _sequence(parts) -> tuple[frozenset[str] | None, Query]:
    """As ``_part``, of parts in a row: strings in a row are joined as long as they are few."""
    run, query, whole = frozenset([""]), _ANY, True
    for kind, value in parts:
        words, asked = _part(str(kind), value)
        longer = None if words is None else _joined(run, words)
        if longer is None:  # what stood in a row so far must be there
            query, whole = _both(_both(query, _strings(run)), asked), False
            run = words if words is not None else frozenset([""])
        else:
            run = longer
    return (run, _ANY) if whole else (None, _both(query, _strings(run)))


def query_of(pattern: str) -> Query:
    """The trigram query that every match of a regex satisfies, by the syntax tree of Python's parser."""
    # these mean other things to Java: vertical spaces, class algebra, folding beyond ASCII
    if "\\v" in pattern or "&&" in pattern or re.search(r"\(\?[a-zA-Z]*[xuU]|\[(?:\\.|[^\]\\])*\[", pattern):
        return _ANY
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("error")  # doubtful syntax, such as nested classes
            tree = _parser.parse(pattern)
    except (re.error, Warning, ValueError, OverflowError):  # syntax that is Java's alone
        return _ANY
    words, query = _sequence(tree)
    return _least(query if words is None else _strings(words))


def queries_of(rules=RULES) -> list[tuple[int, frozenset[str]]]:
    """(rule number, trigrams that must all be there), one an alternative; a rule of which nothing is
    asked has none and scans all texts."""
    return [(k, a) for k, r in enumerate(rules) for q in [query_of(r.pattern)] if frozenset() not in q for a in sorted(q, key=sorted)]


def keys(doc_id: Column, text: Column) -> list[Column]:
    return [F.xxhash64(doc_id, text).alias("k1"), F.xxhash64(F.lit(7), text, doc_id).alias("k2")]


def postings(docs: DataFrame, wanted: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverted index: (gram, k1, k2) for every document and trigram of ``wanted`` in it."""
    body = F.coalesce(docs[f"`{text}`"], F.lit(""))
    rows = docs.select(*keys(docs[f"`{doc_id}`"], docs[f"`{text}`"]), F.translate(body, _UPPER, _LOWER).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(i).cast("short")) for i, g in enumerate(wanted)]))
    return rows.select("k1", "k2", F.explode(held).alias("gram"))


def candidates(docs: DataFrame, rules=RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(k1, k2, rules): the numbers of the rules that a document may match, by intersected postings."""
    asked = queries_of(rules)
    wanted = sorted(set().union(*[g for _, g in asked]))
    place = {g: i for i, g in enumerate(wanted)}
    uses = {i: [w for w, (_, grams) in enumerate(asked) if g in grams] for g, i in place.items()}
    words_of = F.element_at(F.create_map(*[c for i, ws in uses.items() for c in (F.lit(i).cast("short"), F.array(*map(F.lit, ws)))]), F.col("gram"))
    need = F.element_at(F.array(*[F.lit(len(g)) for _, g in asked]), F.col("word") + 1)
    rule = F.element_at(F.array(*[F.lit(k) for k, _ in asked]), F.col("word") + 1)
    index = postings(docs, wanted, doc_id, text).distinct()
    met = index.select("k1", "k2", F.explode(words_of).alias("word")).groupBy("k1", "k2", "word").agg(F.count(F.lit(1)).alias("n"))
    met = met.where(F.col("n") == need).select("k1", "k2", rule.alias("rule"))
    return met.groupBy("k1", "k2").agg(F.collect_set("rule").alias("rules"))


#: Matches that one step of a running sum copies at most.
SUM_BLOCK = 128


def _running(lengths: Column) -> Column:
    """Sums of an array of ints before each element.  Blocks are summed apart, so that a text's cost stays
    near its number of matches."""
    def before(xs: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(xs, start, lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.array_append(a["out"], a["sum"]).alias("out")))["out"]

    n = F.size(lengths)
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((n - 1) / SUM_BLOCK).cast("int"))),
                         lambda b: F.slice(lengths, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK)))
    sums = before(F.transform(blocks, lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)))
    return F.flatten(F.zip_with(blocks, sums, lambda xs, s: F.transform(before(xs), lambda x: x + s)))


def matches(text: Column, rule: Rule) -> Column:
    """Array of (start, end) of a rule's matches, in code points, end exclusive."""
    whole = F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), F.lit(1))
    part = F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), F.lit(1 + rule.group)) if rule.group else whole
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda g: F.length(g))
    sizes = F.transform(whole, lambda m: F.length(m))
    # each match starts after its gap, and all earlier gaps and matches
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(whole)), sizes, lambda g, m: g + m)
    ends = F.zip_with(_running(steps), steps, lambda a, b: a + b)
    placed = F.zip_with(ends, sizes, lambda e, m: F.struct((e - m).alias("start"), e.alias("end")))
    if not rule.least:
        return placed
    long = F.zip_with(placed, part, lambda p, m: F.struct(p["start"].alias("start"), p["end"].alias("end"), (F.length(m) >= rule.least).alias("ok")))
    return F.transform(F.filter(long, lambda x: x["ok"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))


_SPANS = "array<struct<start:int,end:int>>"


def scan(docs: DataFrame, rules=RULES, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) and ``secrets``: (start, kind number, end, kind) in that order.

    A null text is empty and has none.  Every row is judged by its whole text; repeated rows get equal
    results.  A kept column named ``secrets`` is replaced, others may have any name.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() != "secrets"]
    k1, k2 = keys(docs[f"`{doc_id}`"], docs[f"`{text}`"])
    body = F.coalesce(docs[f"`{text}`"], F.lit(""))
    rows = docs.select(F.struct(F.lit(1).alias("_"), *[docs[f"`{c}`"] for c in names]).alias("row"), body.alias("text"), k1, k2)
    indexed = {k for k, _ in queries_of(rules)}
    if indexed:
        found = stored(candidates(docs, rules, doc_id, text), "candidates")
        rows = rows.join(found, ["k1", "k2"], "left")
    else:
        rows = rows.withColumn("rules", F.lit(None).cast("array<int>"))
    by_rule = []
    for k, rule in enumerate(rules):
        asks = F.array_contains("rules", k) if k in indexed else F.col("text").rlike(rule.pattern)
        spans = F.when(F.coalesce(asks, F.lit(False)), matches(F.col("text"), rule)).otherwise(F.array().cast(_SPANS))
        by_rule.append(_named(spans, k, rule.kind))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in names], F.sort_array(F.concat(*by_rule)).alias("secrets"))


def _named(spans: Column, number: int, kind: str) -> Column:
    return F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), F.lit(number).alias("number"), x["end"].alias("end"), F.lit(kind).alias("kind")))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
