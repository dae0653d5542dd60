"""Secret scans by a trigram inverted index, with DataFrame functions only.

Each rule's regular expression is turned into a Boolean query over trigrams that every match must hold (on the
driver, from the rule alone).  The index lists, for each trigram that some rule asks for, the documents with it; a
rule's candidates are the documents on all lists of one of its clauses.  Only candidates are verified with the rule's
expression.  A rule without mandatory trigrams, such as a run of hexadecimal digits, is verified on every document.

Trigrams are taken from lower-cased text, which serves rules that heed case as well as those that don't: the index
only ever admits too much, and verification is exact.

Spans are counted in code points, end exclusive; matches of one rule don't overlap and are the leftmost ones.

Edge cases: a null or empty text has no span; rows that repeat a doc_id are each verified; a row with a null doc_id
is a candidate of every rule; texts are scanned whole; further columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

try:
    from re import _constants as sre
    from re import _parser as parser
except ImportError:  # older Pythons
    import sre_constants as sre
    import sre_parse as parser


@dataclass(frozen=True)
class Rule:
    """``pattern``: for Java and Python alike.  A match counts if its group ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("vcs_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pay_key", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

#: Strings followed at a time while a query is derived; beyond it a query gets weaker, never wrong.
BREADTH = 32
Clauses = frozenset[frozenset[str]]
#: Holds for every text.
ALWAYS: Clauses = frozenset([frozenset()])


def _both(a: Clauses, b: Clauses) -> Clauses:
    return _pruned(frozenset(x | y for x in a for y in b))


def _pruned(clauses: Clauses) -> Clauses:
    """Without clauses that ask for more than another one."""
    if len(clauses) > 64:
        return ALWAYS
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


def _trigrams(strings: frozenset[str]) -> Clauses:
    return _pruned(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def trigram_query(pattern: str) -> Clauses:
    """Clauses of lower-case trigrams: a text with a match has all trigrams of one clause at least."""

    class State:
        """``open``: strings that the text read so far may end in (or is, at the start); ``sure``: what holds already."""

        def __init__(self):
            self.open, self.sure = frozenset([""]), ALWAYS

        def add(self, options: frozenset[str] | None):
            """The next part is one of ``options``, or unknown."""
            if options is not None and len(self.open) * len(options) <= BREADTH:
                self.open = frozenset(a + b for a in self.open for b in options)
                return
            self.sure = _both(self.sure, _trigrams(self.open))
            if options is None:
                self.open = frozenset([""])
                return
            tails = frozenset(s[-2:] for s in self.open)
            self.open = frozenset(a + b for a in tails for b in options) if len(tails) * len(options) <= BREADTH else options if len(options) <= BREADTH else frozenset([""])

        def done(self) -> Clauses:
            return _both(self.sure, _trigrams(self.open))

    def chars(items) -> frozenset[str] | None:
        out: set[str] = set()
        for op, arg in items:
            if op is sre.LITERAL:
                out.add(chr(arg).lower())
            elif op is sre.RANGE:
                if arg[1] - arg[0] > 200:
                    return None
                out.update(chr(c).lower() for c in range(arg[0], arg[1] + 1))
            else:
                return None
        return frozenset(out)

    def walk(tree, state: State) -> None:
        for op, arg in tree:
            if op is sre.LITERAL:
                state.add(frozenset([chr(arg).lower()]))
            elif op is sre.IN:
                state.add(chars(arg))
            elif op is sre.SUBPATTERN:
                walk(arg[-1], state)
            elif op is sre.BRANCH:
                options: set[str] | None = set()
                parts = []
                for branch in arg[1]:
                    s = State()
                    walk(branch, s)
                    parts.append(s)
                    if s.sure != ALWAYS or options is None:
                        options = None
                    else:
                        options |= s.open
                if options is not None and len(options) <= BREADTH and all(_fixed(b) for b in arg[1]):
                    state.add(frozenset(options))
                else:
                    state.add(None)
                    state.sure = _both(state.sure, _pruned(frozenset().union(*(p.done() for p in parts))))
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
                low, high, body = arg
                if (low, high) == (0, 1) and _fixed(body):
                    s = State()
                    walk(body, s)
                    state.add(s.open | {""} if s.sure == ALWAYS else None)
                else:
                    for _ in range(min(low, 4)):
                        walk(body, state)
                    if low > 4 or low != high:
                        state.add(None)
            elif op is sre.AT:
                pass
            else:
                state.add(None)

    def _fixed(tree) -> bool:
        """Whether the part is one of a few strings, with nothing unknown inside."""
        for op, arg in tree:
            if op is sre.LITERAL or (op is sre.IN and chars(arg) is not None):
                continue
            if op is sre.SUBPATTERN and _fixed(arg[-1]):
                continue
            if op is sre.BRANCH and all(_fixed(b) for b in arg[1]):
                continue
            if op is sre.MAX_REPEAT and arg[1] != sre.MAXREPEAT and arg[1] <= 1 and _fixed(arg[2]):
                continue
            return False
        return True

    state = State()
    walk(parser.parse(pattern), state)
    found = state.done()
    # Characters beyond ASCII are left to verification: their lower case may be longer than one character.
    ascii_only = set(map(chr, range(128)))
    return _pruned(frozenset(frozenset(t for t in c if set(t) <= ascii_only) for c in found))


def index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: a row (trigram, doc_id) for each of ``trigrams`` that a document has."""
    low = docs.select("doc_id", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("doc_id", F.explode(held).alias("trigram"))


def candidates(postings: DataFrame, queries: dict[str, Clauses]) -> DataFrame:
    """doc_id with ``kinds``, the rules that it is a candidate of: lists intersected by clause, united by rule.

    The counts of lists by document and clause are added up before they are shuffled.  A document has one bit for
    each trigram it is listed under; what is shuffled is one row for each document of a task.
    """
    names = sorted({t for q in queries.values() for c in q for t in c})
    spot = {t: i for i, t in enumerate(names)}
    words = -(-len(names) // 63)
    bit = [sum((F.when(F.col("trigram") == t, F.lit(1 << (i % 63))).otherwise(F.lit(0)) for t, i in spot.items() if i // 63 == w), F.lit(0)) for w in range(words)]
    lists = postings.filter(F.col("trigram").isin(names)).groupBy("doc_id").agg(*[F.bit_or(b.cast("long")).alias(f"list{w}") for w, b in enumerate(bit)])

    def holds(clause: frozenset[str]) -> Column:
        need = [sum(1 << (spot[t] % 63) for t in clause if spot[t] // 63 == w) for w in range(words)]
        ok = F.lit(True)
        for w, n in enumerate(need):
            if n:
                ok = ok & (F.col(f"list{w}").bitwiseAND(F.lit(n)) == F.lit(n))
        return ok

    kinds = []
    for kind, query in queries.items():
        any_clause = F.lit(False)
        for c in sorted(query, key=sorted):
            any_clause = any_clause | holds(c)
        kinds.append(F.when(any_clause, F.lit(kind)))
    return lists.select("doc_id", F.array_compact(F.array(*kinds)).alias("kinds")).filter(F.size("kinds") > 0)


def _spans(rule: Rule, order: int, text: str = "text") -> Column:
    """Spans of a rule's matches in a text: the lengths of matches and of what lies between them add up to places."""
    java = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, java, F.lit(0))
    counted = F.regexp_extract_all(text, java, F.lit(rule.group)) if rule.group else found
    between = F.split(F.col(text), rule.pattern, -1)
    parts = F.arrays_zip(F.transform(found, lambda m: F.length(m)).alias("m"), F.transform(counted, lambda m: F.length(m)).alias("g"), F.transform(F.slice(between, F.lit(1), F.size(found)), lambda m: F.length(m)).alias("b"))
    kind = "struct<start:int,rank:int,end:int,kind:string>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("spans"))

    def step(acc, x):
        start = acc["at"] + x["b"]
        end = start + x["m"]
        one = F.array(F.struct(start.alias("start"), F.lit(order).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind")))
        return F.struct(end.alias("at"), F.when(x["g"] >= rule.least, F.concat(acc["spans"], one)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(parts, zero, step, lambda acc: acc["spans"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``spans``: structs start, rank (of the rule), end, kind, sorted.

    Texts are shuffled once, to meet the candidate lists; a doc_id stands for one document, so no key is hot.  A column
    of ``docs`` that is named ``spans`` is replaced.
    """
    return _scanned(docs.drop("spans"), rules, id_col, text_col, "spans")


def _scanned(docs: DataFrame, rules: tuple[Rule, ...], id_col: str, text_col: str, spans: str) -> DataFrame:
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q != ALWAYS}
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    rows = docs
    if indexed:
        names = sorted({t for q in indexed.values() for c in q for t in c})
        own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id is not null and text is not null")
        listed = candidates(index(own, names), indexed).select(F.col("doc_id").alias("_listed"), F.col("kinds").alias("_kinds"))
        rows = docs.join(listed, docs[id_col] == listed["_listed"], "left").drop("_listed")
    else:
        rows = docs.withColumn("_kinds", F.array().cast("array<string>"))
    found = []
    for i, r in enumerate(rules):
        if r.kind in indexed:
            may = F.col(id_col).isNull() | F.coalesce(F.array_contains("_kinds", r.kind), F.lit(False))
        else:
            may = F.col(text_col).rlike(r.pattern)
        found.append(F.when(may & F.col(text_col).isNotNull(), _spans(r, i, text_col)).otherwise(none))
    return rows.withColumn(spans, F.array_sort(F.concat(*found))).drop("_kinds")


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(scanned: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts of the base rules' spans, a hash over these spans, and all spans as a string."""
    base = [i for i, r in enumerate(rules) if r.base]
    of_base = F.filter("spans", lambda s: s["rank"].isin(base))
    of_rank = lambda i: lambda s: s["rank"] == i
    counts = [F.size(F.filter("spans", of_rank(i))).cast("long").alias(f"n_{rules[i].kind}") for i in base]
    return scanned.select("doc_id", *counts, F.sha2(_written(of_base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with every span of a secret replaced by ``mark``; overlapping spans get one mark."""
    found = _scanned(docs, rules, id_col, text_col, "_spans")
    text = F.col(text_col)
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        gap = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, gap).otherwise(acc["out"]).alias("out"))

    end = F.aggregate("_spans", zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return found.withColumn(text_col, F.when(F.size("_spans") > 0, end).otherwise(text)).drop("_spans")


def oracle_sql(documents: str = "documents", rules: tuple[Rule, ...] = RULES) -> str:
    """The digest in SQL for DuckDB, by scanning every text with every rule."""
    parts = []
    for i, r in enumerate(rules):
        p = r.pattern.replace("(?i:(password|passwd|secret|token|api_?key))", "(" + "|".join("".join(f"[{c}{c.upper()}]" if c in string.ascii_lowercase else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")")
        p = p.replace("'", "''")
        g = f"regexp_extract_all(text, '{p}', {r.group})"
        # What lies between matches: the text split where each match has become one character that no text has
        cut = f"string_split(regexp_replace(text, '{p}', chr(1114110), 'g'), chr(1114110))"
        parts.append(f"SELECT rid, {i} AS rank, '{r.kind}' AS kind, {r.least} AS least, regexp_extract_all(text, '{p}', 0) AS m, {g} AS g, {cut} AS b FROM t")
    base = ", ".join(str(i) for i, r in enumerate(rules) if r.base)
    counts = ", ".join(f"count(*) FILTER (rank = {i}) AS n_{r.kind}" for i, r in enumerate(rules) if r.base)
    outer = ", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in rules if r.base)
    return f"""WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM {documents}),
found AS ({' UNION ALL '.join(parts)}),
each AS (SELECT rid, rank, kind, least, unnest(range(1, len(m) + 1)) AS k, m, g, b FROM found),
spans AS (SELECT rid, rank, kind, length(g[k]) AS n, list_sum(list_transform(b[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k-1], lambda x: length(x))), 0) AS start, length(m[k]) AS len, least FROM each),
kept AS (SELECT rid, rank, start, kind || ':' || start::BIGINT::VARCHAR || ':' || (start + len)::BIGINT::VARCHAR AS span FROM spans WHERE n >= least),
sums AS (SELECT rid, {counts}, string_agg(span, ',' ORDER BY start, rank) FILTER (rank IN ({base})) AS base, string_agg(span, ',' ORDER BY start, rank) AS spans FROM kept GROUP BY rid)
SELECT doc_id, {outer}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN sums USING (rid)"""


def matches(text: str, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, int, str]]:
    """The spans of one text, by Python's expressions.  Only ASCII letters have another case here, as for Java."""
    found = [(m.start(), i, m.end(), r.kind) for i, r in enumerate(rules) for m in re.finditer(r.pattern.replace("(?i:", "(?ai:"), text) if len(m[r.group]) >= r.least]
    return sorted(found)
