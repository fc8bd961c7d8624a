"""Secret scans with a trigram inverted index (DataFrame functions only).

Each rule's regular expression implies a Boolean query of trigrams: whatever it
matches holds all trigrams of one of the query's terms.  The index lists, for every
trigram that a rule asks for, the texts that hold it; postings are intersected block
by block, and only the texts that remain are searched with the rule.  A rule whose
expression has no mandatory trigram is searched for in all texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import product
from re import _constants as sre
from re import _parser as sre_parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import partitions, stored


class Rule(NamedTuple):
    """A kind of secret: ``group`` of a match of ``pattern`` has ``least`` characters or more."""
    kind: str
    pattern: str
    group: int
    least: int
    base: bool = False


# The base rules, and further public formats of credentials.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]+", 0, 40),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("slack", r"xox[abpr]-[A-Za-z0-9-]+", 0, 20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
)

MOST_STRINGS = 64       # alternatives followed through an expression; beyond, a piece counts as unknown
MOST_CHARACTERS = 6     # members of a class that are followed one by one
BLOCKS = 16             # blocks of the index for each shuffle partition
SALTS = 16              # parts of the rows of one text
_CHUNK = 512

Query = frozenset       # of terms; a term is a frozenset of trigrams, all of which a match holds
ANY: Query = frozenset([frozenset()])


def _minimal(terms: Iterable[frozenset]) -> Query:
    """Without terms that another one already covers."""
    terms = set(terms)
    return frozenset(t for t in terms if not any(o < t for o in terms))


def _query(strings: set[str]) -> Query:
    return _minimal(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


def _both(a: Query, b: Query) -> Query:
    """All of a term of each; where that has too many terms, the shorter query alone."""
    if len(a) * len(b) > MOST_STRINGS:
        return min(a, b, key=len)
    return _minimal(x | y for x, y in product(a, b))


def _characters(items) -> set[str] | None:
    """The members of a character class, lower-cased; None where it is not a short list."""
    out = set()
    for op, value in items:
        if op is sre.LITERAL:
            out.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < MOST_STRINGS:
            out.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return out if len(out) <= MOST_CHARACTERS else None


class _Walk:
    """Follows an expression from left to right: ``strings`` are the ways in which the
    stretch read last can be spelt, ``query`` is what the stretches before it imply."""

    def __init__(self):
        self.strings, self.query = {""}, ANY

    def extend(self, more: set[str] | None) -> None:
        if more is not None and len(self.strings) * len(more) <= MOST_STRINGS:
            self.strings = {a + b for a, b in product(self.strings, more)}
        else:
            self.cut(more if more is not None and len(more) <= MOST_STRINGS else None)

    def cut(self, then: set[str] | None = None) -> None:
        """The stretch ends; what follows starts with one of ``then``, or anything."""
        self.query = _both(self.query, _query(self.strings))
        self.strings = then or {""}

    def read(self, nodes) -> None:
        for op, value in nodes:
            if op is sre.LITERAL:
                self.extend({chr(value).lower()})
            elif op is sre.IN:
                self.extend(_characters(value))
            elif op is sre.SUBPATTERN:
                self.read(value[3])
            elif op is sre.BRANCH:
                self._branch([_read(part) for part in value[1]])
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
                self._repeat(*value)
            elif op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
                continue
            else:
                self.cut()

    def _branch(self, parts: list[_Walk]) -> None:
        if all(p.query == ANY for p in parts):
            self.extend(set().union(*(p.strings for p in parts)))
        else:
            self.cut()
            self.query = _both(self.query, _minimal(t for p in parts for t in p.whole()))

    def _repeat(self, least: int, most: int, nodes) -> None:
        inner = _read(nodes)
        known = inner.strings if inner.query == ANY else None
        if most == 1 and known is not None:
            self.extend(known | {""})
        elif least == 0:
            self.cut()
        elif known is None:
            self.cut()
            self.query = _both(self.query, inner.whole())
        else:
            for _ in range(min(least, 4)):
                self.extend(known)
            if most != least or least > 4:
                self.cut(known)

    def whole(self) -> Query:
        return _both(self.query, _query(self.strings))


def _read(nodes) -> _Walk:
    walk = _Walk()
    walk.read(nodes)
    return walk


def trigram_query(pattern: str) -> Query:
    """Terms of lower-cased trigrams: every match of ``pattern``, lower-cased, holds all
    trigrams of at least one of them.  ``ANY`` where nothing is mandatory."""
    query = _read(sre_parser.parse(pattern)).whole()
    return ANY if frozenset() in query else query


def build_index(spark: SparkSession, texts: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``texts(h, text)`` -> ``(block, trigram, postings)``: sorted ``h`` of the texts that
    hold the trigram in either case, for the trigrams that a rule asks for.  Texts are
    dealt over blocks by ``h``, so that no posting list grows with the table."""
    asked = sorted({t for rule in rules for term in trigram_query(rule.pattern) for t in term})
    held = texts.select("h", F.lower("text").alias("l"))
    held = held.select("h", F.explode(F.array(*[F.when(F.contains("l", F.lit(t)), F.lit(t)) for t in asked])).alias("trigram"))
    held = held.filter("trigram is not null")
    blocks = BLOCKS * partitions(spark)
    return (held.groupBy(F.pmod("h", F.lit(blocks)).alias("block"), "trigram")
            .agg(F.sort_array(F.collect_set("h")).alias("postings")))


def candidates(index: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``(h, kinds)``: the texts whose trigrams satisfy the query of the rules ``kinds``;
    rules without a mandatory trigram are in no row."""
    block = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "postings"))).alias("m"))
    none = F.array().cast("array<bigint>")

    def term(trigrams: frozenset) -> Column:
        out = None
        for t in sorted(trigrams):
            some = F.coalesce(F.try_element_at("m", F.lit(t)), none)
            out = some if out is None else F.array_intersect(out, some)
        return out

    def texts(rule: Rule, query: Query) -> Column:
        held = F.array_distinct(F.flatten(F.array(*[term(t) for t in sorted(query, key=sorted)])))
        return F.transform(held, lambda h: F.struct(h.alias("h"), F.lit(rule.kind).alias("kind")))

    queries = [(rule, trigram_query(rule.pattern)) for rule in rules]
    found = [texts(rule, query) for rule, query in queries if query != ANY]
    # A text's candidates are all in its block: they are put together there, without a shuffle.
    rows = block.select(F.explode(F.flatten(F.array(*found))).alias("c")) if found else block.select(
        F.lit(None).cast("struct<h:bigint,kind:string>").alias("c")).limit(0)
    return rows.groupBy("c.h").agg(F.sort_array(F.collect_set("c.kind")).alias("kinds"))


def _sums_before(lengths: str) -> Column:
    """For every entry of an array column the sum of those before it; work is linear
    but for chunks of ``_CHUNK`` entries."""
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("before"))

    def add(acc: Column, x: Column) -> Column:
        return F.struct((acc["sum"] + x).alias("sum"), F.array_append(acc["before"], acc["sum"]).alias("before"))

    chunks = F.transform(F.sequence(F.lit(0), F.floor(F.size(lengths) / _CHUNK).cast("int")),
                         lambda c: F.aggregate(F.slice(F.col(lengths), c * _CHUNK + 1, F.lit(_CHUNK)), start, add))
    shifted = F.aggregate(chunks, F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<array<bigint>>").alias("out")),
                          lambda acc, c: F.struct((acc["sum"] + c["sum"]).alias("sum"), F.array_append(
                              acc["out"], F.transform(c["before"], lambda b: b + acc["sum"])).alias("out")))
    return F.flatten(shifted["out"])


def _search(rule: Rule) -> str:
    """The expression searched for.  Matches of one repeated class are whole stretches of
    it: those too short are left out by the expression itself."""
    one_class = rule.group == 0 and rule.pattern.startswith("[") and rule.pattern.find("]") == len(rule.pattern) - 2
    return f"{rule.pattern[:-1]}{{{rule.least},}}" if one_class and rule.pattern.endswith("+") else rule.pattern


def _spans(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds columns ``found_<i>``: spans in ``text`` of rule i, where ``asked_<i>`` holds.
    Matches are the leftmost ones that do not overlap; their positions come from the
    lengths of the matches and of the texts between them."""
    n = range(len(rules))

    def hit(i: int, value: Column) -> Column:
        return F.when(F.col(f"asked_{i}"), value)

    def matches(i: int, group: int) -> Column:
        return F.transform(F.regexp_extract_all("text", F.lit(_search(rules[i])), F.lit(group)), F.char_length)

    def spans(i: int) -> Column:
        def span(z: Column) -> Column:
            start = z[f"b_{i}"] + z[f"s_{i}"]["g"]
            return F.struct(start.alias("start"), F.lit(i).alias("number"), (start + z[f"s_{i}"]["m"]).alias("end"),
                            F.lit(rules[i].kind).alias("kind"), (z[f"w_{i}"] >= rules[i].least).alias("holds"))
        return F.filter(F.transform(F.arrays_zip(f"s_{i}", f"w_{i}", f"b_{i}"), span), lambda s: s["holds"])

    # A quick test first, which most texts fail.
    rows = rows.select("id", "text", *[(F.col(f"asked_{i}") & F.col("text").rlike(_search(rules[i]))).alias(f"asked_{i}") for i in n])
    rows = rows.select("id", "text", *[c for i in n for c in (
        hit(i, matches(i, 0)).alias(f"m_{i}"), hit(i, matches(i, rules[i].group)).alias(f"w_{i}"),
        hit(i, F.transform(F.split("text", _search(rules[i]), -1), F.char_length)).alias(f"g_{i}"))])
    rows = rows.select("*", *[F.zip_with(F.slice(f"g_{i}", F.lit(1), F.size(f"m_{i}")), f"m_{i}", lambda g, m: F.struct(
        g.alias("g"), m.alias("m"))).alias(f"s_{i}") for i in n])
    rows = rows.select("*", *[F.transform(f"s_{i}", lambda s: (s["g"] + s["m"]).cast("long")).alias(f"l_{i}") for i in n])
    rows = rows.select("id", *[c for i in n for c in (
        f"s_{i}", f"w_{i}", F.when(F.size(f"l_{i}") > 0, _sums_before(f"l_{i}")).alias(f"b_{i}"))])
    return rows.select("id", *[F.coalesce(spans(i), F.array().cast(_SPANS)).alias(f"found_{i}") for i in n])


_SPANS = "array<struct<start:bigint,number:int,end:bigint,kind:string,holds:boolean>>"


def scan(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per row of ``docs`` the id and ``spans``: array of kind, start, end (code points,
    end exclusive) of the secrets found, by start, then by the rules' order.

    A null text counts as empty and has no spans; null ids and repeated rows stay as
    they are; other columns are left out.  An empty table gives no rows.  Candidates
    are found by a 64-bit hash of the text: two texts of one hash are both searched."""
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("h", F.xxhash64("text"))
    found = candidates(stored(spark, build_index(spark, base, rules), "trigrams"), rules)
    # Rows of one text may be many: they are dealt over salts, the candidates copied to each.
    found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = base.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    rows = rows.join(found, ["h", "salt"], "left").select("id", "text", "kinds")

    def asked(rule: Rule) -> Column:
        if trigram_query(rule.pattern) == ANY:
            return F.lit(True)
        return F.coalesce(F.array_contains("kinds", F.lit(rule.kind)), F.lit(False))

    rows = _spans(rows.select("id", "text", *[asked(r).alias(f"asked_{i}") for i, r in enumerate(rules)]), rules)
    spans = F.transform(F.array_sort(F.concat(*[f"found_{i}" for i in range(len(rules))])), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select(F.col("id").alias(id_col), spans.alias("spans"))
