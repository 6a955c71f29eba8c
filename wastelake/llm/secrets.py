"""Secret scans over a trigram inverted index.

From every rule's pattern the trigrams are derived that a match must contain: a list of
clauses, each with alternatives, each a set of trigrams. Postings of the trigrams are
intersected to the documents that meet all clauses of a rule, and only these are verified
with the pattern itself. A pattern without mandatory trigrams is verified on every document.
The index is in lower case and may only propose too many documents, never too few.

Matches of a kind are leftmost and do not overlap; a match whose tested group is too short
is dropped after it was consumed. Positions count code points, ends are exclusive.

Nulls count as empty texts without spans. Rows of equal id are proposed together and
verified each on its own text. An empty table gives an empty result. Columns other than
those named are only carried.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

MOST_STRINGS = 64
MARK = "[SECRET]"
BLOCK = 256  # code points; a text is cut into these to find a place in it


def any_case(pattern: str) -> str:
    """The pattern with a-z read in either case, and no other letters folded onto them."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", pattern)


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # the part whose length is tested
    least: int = 0  # code points that it needs
    base: bool = False


RULES = (
    Rule("assign", f"({any_case('password|passwd|secret|token|api_?key')})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),  # a longest run of hex digits, if it is long enough
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("code_host", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
)


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _strings(items) -> set[str] | None:
    """All strings that a parsed pattern stands for, in lower case; None if there are too many."""
    out = {""}
    for op, value in items:
        name = str(op)
        if name == "LITERAL":
            more = {chr(value).lower()}
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in value):
            more = {chr(v).lower() for _, v in value}
        elif name == "SUBPATTERN":
            more = _strings(value[3])
        elif name == "BRANCH":
            parts = [_strings(branch) for branch in value[1]]
            more = None if None in parts else set().union(*parts)
        elif name == "MAX_REPEAT" and value[1] == 1:
            more = _strings(value[2])
            more = None if more is None else more | ({""} if value[0] == 0 else set())
        else:
            more = None
        if more is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = {a + b for a, b in product(out, more)}
    return out


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Clauses that all must hold; a clause holds if all trigrams of an alternative occur."""
    clauses, run = [], [""]

    def close() -> None:
        sets = {trigrams(s) for s in run}
        if all(sets):  # an alternative that contains another adds nothing
            clauses.append(sorted((s for s in sets if not any(o < s for o in sets)), key=sorted))
        run[:] = [""]

    for item in re._parser.parse(pattern):
        strings = _strings([item])
        if strings is None or len(run) * len(strings) > MOST_STRINGS:
            close()
            strings = strings or {""}
        run[:] = sorted({a + b for a, b in product(run, strings)})
    close()
    return clauses


def postings(docs: DataFrame, wanted: list[str], doc_id: str, text: str) -> DataFrame:
    """The inverted index of the trigrams that the rules ask for: `(trigram, doc_id)`."""
    low = docs.select(F.col(doc_id).alias("doc_id"), F.lower(F.col(text)).alias("low"))
    has = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted])
    return low.select("doc_id", F.explode(F.array_compact(has)).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...], doc_id: str, text: str) -> DataFrame:
    """`(doc_id, kinds)`: the rules whose trigram queries the documents of an id meet.

    One row per id and at most one entry per rule, so the lists are short.
    """
    asked = [(r.kind, c, a, t, len(alternative), len(clauses))
             for r in rules for clauses in [trigram_query(r.pattern)] for c, clause in enumerate(clauses)
             for a, alternative in enumerate(clause) for t in sorted(alternative)]
    wanted = sorted({row[3] for row in asked})
    query = docs.sparkSession.createDataFrame(asked, "kind string, clause int, alternative int, trigram string, trigrams int, clauses int")
    hits = postings(docs, wanted, doc_id, text).join(F.broadcast(query), "trigram")  # as many rows as the rules have trigrams
    met = hits.groupBy("doc_id", "kind", "clause", "alternative", "trigrams", "clauses").agg(
        F.count_distinct("trigram").alias("n")).filter("n = trigrams")
    whole = met.groupBy("doc_id", "kind", "clauses").agg(F.count_distinct("clause").alias("n")).filter("n = clauses")
    return whole.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Every element combined with all before it, by looking back 1, 2, 4, ... places; with null where there is none."""
    back = F.array(*[F.lit(1 << i) for i in range(31)])
    return F.aggregate(back, values, lambda done, d: F.when(
        d < F.size(done), F.transform(done, lambda x, i: combine(x, F.get(done, i - d)))).otherwise(done))


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """The spans of a kind as structs `(start, order, end, kind)`.

    The text between matches and the matches alternate, so their lengths add up to positions.
    The work is linear in the text, and n log n in its matches.
    """
    pattern = F.lit(rule.pattern)
    lengths = lambda strings: F.transform(strings, F.length)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    tested = matches if not rule.group else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    rows = F.arrays_zip(lengths(F.slice(F.split(text, rule.pattern, -1), 1, F.size(matches))).alias("gap"),
                        lengths(matches).alias("size"), lengths(tested).alias("tested"))
    ending = F.transform(rows, lambda m: F.struct((m["gap"] + m["size"]).alias("end"), m["size"].alias("size"), m["tested"].alias("tested")))
    placed = running(ending, lambda m, earlier: F.struct(
        (m["end"] + F.coalesce(earlier["end"], F.lit(0))).alias("end"), m["size"].alias("size"), m["tested"].alias("tested")))
    rows = F.filter(placed, lambda m: m["tested"] >= rule.least)
    found = F.transform(rows, lambda m: F.struct(
        (m["end"] - m["size"]).alias("start"), F.lit(order).alias("order"), m["end"].alias("end"), F.lit(rule.kind).alias("kind")))
    return F.when(F.rlike(text, pattern), found).otherwise(F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>"))


def found(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """The rows with all columns and one more, whose name is returned: their spans.

    Spans are structs `(start, order, end, kind)` in the order of their starts.
    """
    key, kinds, spans = common.fresh(docs, "span_key"), common.fresh(docs, "span_kinds"), common.fresh(docs, "spans")
    proposed = candidates(docs, rules, doc_id, text).toDF(key, kinds)
    joined = docs.join(proposed, F.col(doc_id).eqNullSafe(F.col(key)), "left")
    body, empty = F.coalesce(F.col(text), F.lit("")), F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    parts = [spans_of(body, r, i) if not trigram_query(r.pattern) else
             F.when(F.array_contains(kinds, r.kind), spans_of(body, r, i)).otherwise(empty) for i, r in enumerate(rules)]
    return joined.withColumn(spans, F.array_sort(F.concat(*parts))).drop(key, kinds), spans


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scanned(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, n_<kind> of the base kinds, base_sha256, spans)` of every row."""
    rows, name = found(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), rules, "doc_id", "text")
    base = [r.kind for r in rules if r.base]
    of = lambda *kinds: F.filter(name, lambda s: s["kind"].isin(*kinds))
    return rows.select(
        "doc_id", *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in base],
        F.sha2(written(of(*base)).cast("binary"), 256).alias("base_sha256"), written(F.col(name)).alias("spans"))


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text",
             length: str | None = None, mark: str = MARK) -> DataFrame:
    """The rows with every span of their text replaced by `mark`; overlapping spans by one.

    `length` names a column with the text's code points, which is renewed.
    """
    rows, name = found(docs, rules, doc_id, text)
    body = F.col(text)
    spans, blocks, before = (common.fresh(rows, x) for x in ("s_spans", "s_blocks", "s_before"))
    has = F.size(name) > 0
    # Where a span begins before an earlier one ends, the text between them is part of a mark.
    reach = running(F.transform(name, lambda s: s["end"]), F.greatest)  # that passes over null
    rows = rows.withColumn(before, F.when(has, F.concat(F.array(F.lit(0)), reach)))
    apart = F.filter(F.transform(name, lambda s, i: F.struct(s["start"].alias("start"), F.get(before, i).alias("before"))),
                     lambda s: s["start"] >= s["before"])
    rows = rows.withColumns({spans: F.when(has, apart), blocks: F.when(has, F.regexp_extract_all(body, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))})

    def between(a: Column, b: Column) -> Column:
        first = F.floor(a / BLOCK).cast("int")
        near = F.array_join(F.slice(blocks, first + 1, F.floor(b / BLOCK).cast("int") - first + 1), "")
        return F.substring(near, a - first * BLOCK + 1, b - a)

    pieces = F.transform(spans, lambda s: F.concat(between(s["before"], s["start"]), F.lit(mark)))
    last = F.element_at(before, -1)
    cleaned = F.concat(F.array_join(pieces, ""), between(last, F.length(body)))
    new = rows.withColumn(text, F.when(F.size(name) > 0, cleaned).otherwise(body))
    if length:
        new = new.withColumn(length, F.when(F.size(name) > 0, F.length(text)).otherwise(F.col(length)).cast(docs.schema[length].dataType))
    return new.select(*docs.columns)


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The same in DuckDB's SQL, without an index."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    parts = []
    for i, r in enumerate(rules):
        p = quoted(r.pattern)
        parts.append(f"""
  SELECT row, list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
      'start': coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0),
      'order': {i}, 'size': length(m[i]), 'tested': length(tested[i]), 'kind': '{r.kind}'}}), lambda s: s.tested >= {r.least}) AS s
  FROM (SELECT row, regexp_extract_all(body, {p}) AS m, regexp_extract_all(body, {p}, {r.group}) AS tested, string_split_regex(body, {p}) AS gaps
        FROM docs WHERE regexp_matches(body, {p}))""")
    base = ", ".join(f"'{r.kind}'" for r in rules if r.base)
    text = lambda spans: f"list_aggregate(list_transform({spans}, lambda p: concat(p.kind, ':', p.start::BIGINT, ':', (p.start + p.size)::BIGINT)), 'string_agg', ',')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS body FROM documents),
parts AS ({' UNION ALL '.join(parts)}),
together AS (SELECT row, list_sort(flatten(list(s))) AS s FROM parts GROUP BY row),
spans AS (SELECT doc_id, coalesce(s, []) AS s, list_filter(coalesce(s, []), lambda x: x.kind IN ({base})) AS b FROM docs LEFT JOIN together USING (row))
SELECT doc_id, {', '.join(f"len(list_filter(s, lambda x: x.kind = '{r.kind}'))::BIGINT AS n_{r.kind}" for r in rules if r.base)},
       sha256(coalesce({text('b')}, '')) AS base_sha256, coalesce({text('s')}, '') AS spans
FROM spans"""
