"""Secret scans through a trigram index. DataFrame expressions only.

From each rule's pattern a Boolean query over trigrams is derived that every
match must satisfy. A table of postings (trigram, document) is written for the
trigrams that the rules ask for; the postings of a rule are intersected per
document, and only documents that satisfy its query are read by its pattern.
A rule whose pattern has no mandatory trigram reads every document.

Texts are not shuffled while the table of candidates (document, rules) measures
small enough to be broadcast; beyond that Spark joins the two tables by document.
Postings are narrow, aggregated before their shuffle, and kept in the shared
folder, so that a lost executor costs a re-read.

Defined cases: a null text is the empty string and holds nothing; repeated rows
and repeated or null document ids are each scanned on their own text (postings
of one id are united, which can only add candidates); an empty table gives no
rows; further columns stay as they are, but for one named ``spans``, which is
replaced.
"""

import re._parser as patterns
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import broadcast_if_small, materialize

WORD_BITS = 62  # trigrams of one mask column
EXPANDED = 64  # strings a pattern's part may stand for before it is cut
BLOCK = 128  # spans that are put into place, or cut out of a text, together


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the least length of one group of it.

    The pattern is read alike by Java and Python. A match with a shorter group
    is dropped, but what it covers is not searched again.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base kinds, in the order in which they are listed.
# [0-9a-f]+ and AKIA[A-Z0-9]+ carry their least length in the pattern: a match
# is a whole run there, so that dropping short runs and not matching them agree.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 12,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]+"),
)
RULES = BASE_RULES + MORE_RULES


# Boolean queries: True (any document), a trigram, ("and", ...), ("or", ...).


def _all(parts):
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _any(parts):
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _of_strings(strings):
    return _any(_all(s[i:i + 3] for i in range(len(s) - 2)) for s in sorted(strings))


def _analyse(items):
    """(strings, query) of a sequence: all it can match if they are few, or
    None, and the query that every match satisfies."""
    run, parts, cut = {""}, [], False
    for kind, value in items:
        strings, query = _item(str(kind), value)
        if strings is not None and len(run) * len(strings) <= EXPANDED:
            run = {a + b for a in run for b in strings}
        else:
            parts += [_of_strings(run), query if strings is None else _of_strings(strings)]
            run, cut = {""}, True
    return (None if cut else run), _all([*parts, _of_strings(run)])


def _item(kind, value):
    if kind == "LITERAL" and value < 128:
        return {chr(value).lower()}, True
    if kind == "AT":
        return {""}, True
    if kind == "IN" and all(str(k) == "LITERAL" and v < 128 for k, v in value):
        return {chr(v).lower() for _, v in value}, True
    if kind == "SUBPATTERN":
        return _analyse(value[-1])
    if kind == "BRANCH":
        found = [_analyse(branch) for branch in value[1]]
        if all(strings is not None for strings, _ in found):
            return set().union(*(strings for strings, _ in found)), True
        return None, _any(query for _, query in found)
    if kind == "MAX_REPEAT":
        least, most, inner = value
        strings, query = _analyse(inner)
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, True
        if least:
            return None, query if strings is None else _of_strings(strings)
    return None, True


def trigram_query(pattern: str):
    """The Boolean trigram query of a pattern, over lower-case text."""
    return _analyse(patterns.parse(pattern))[1]


def trigrams(query):
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1:]))


def postings(docs: DataFrame, wanted, doc="doc_id", text="text") -> DataFrame:
    """(trigram, document) for the wanted trigrams, written by trigram."""
    low = docs.select(F.col(doc).alias("doc"), F.lower(F.col(text)).alias("low"))
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted]))
    return materialize(
        low.select("doc", F.explode(present).alias("trigram")), "trigram-postings", partition_by="trigram"
    )


def candidates(index: DataFrame, rules) -> DataFrame:
    """(doc, rules): the bit mask of the rules whose query a document satisfies."""
    queries = {r: trigram_query(rule.pattern) for r, rule in enumerate(rules)}
    queries = {r: q for r, q in queries.items() if q is not True}
    wanted = sorted(set().union(*map(trigrams, queries.values())))
    place = {t: divmod(i, WORD_BITS) for i, t in enumerate(wanted)}
    masks = [
        F.bit_or(reduce(
            lambda rest, t: F.when(F.col("trigram") == t, F.lit(1 << place[t][1]).cast("bigint")).otherwise(rest),
            (t for t in wanted if place[t][0] == word), F.lit(0).cast("bigint"),
        )).alias(f"m{word}")
        for word in range(-(-len(wanted) // WORD_BITS))
    ]

    def holds(query) -> Column:
        if isinstance(query, str):
            word, bit = place[query]
            return F.col(f"m{word}").bitwiseAND(F.lit(1 << bit)) != 0
        op = Column.__and__ if query[0] == "and" else Column.__or__
        return reduce(op, map(holds, query[1:]))

    mask = reduce(
        Column.bitwiseOR,
        (F.when(holds(q), F.lit(1 << r)).otherwise(F.lit(0)).cast("bigint") for r, q in queries.items()),
    )
    hits = index.filter(F.col("trigram").isin(wanted)).groupBy("doc").agg(*masks)
    return hits.select("doc", mask.alias("rules")).filter("rules <> 0")


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(items: Column) -> Column:
    """An array as slices of BLOCK, at least one. Arrays grow by copying, so they are
    appended to within a slice only: the work grows with the items, not their square."""
    last = F.greatest(F.size(items) - 1, F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), F.floor(last / BLOCK).cast("int")), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))


def _starts(blocks: Column, step) -> Column:
    """The running value before each block; ``step`` takes it past a block."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(
        blocks, state,
        lambda acc, block: F.struct(
            step(acc["at"], block).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"],
    )


def rule_spans(text: Column, rule: Rule, number: int) -> Column:
    """Spans (start, kind, end) of one rule in code points, leftmost first.

    A pattern's matches and the pieces between them alternate, so their lengths
    give the places.
    """
    pattern = F.lit(rule.pattern)
    value = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    parts = _bound(F.regexp_extract_all(text, pattern, F.lit(0)), lambda whole: F.zip_with(
        F.zip_with(
            F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(whole)), whole,
            lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("size")),
        ),
        value,
        lambda part, v: F.struct(part["gap"].alias("gap"), part["size"].alias("size"),
                                 (F.length(v) >= rule.least).alias("kept")),
    ))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def step(acc, part):
        start = acc["at"] + part["gap"]
        end = start + part["size"]
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(part["kept"], F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    def placed(blocks):
        starts = _starts(blocks, lambda at, block: F.aggregate(block, at, lambda n, part: n + part["gap"] + part["size"]))
        return F.flatten(F.zip_with(blocks, starts, lambda block, at: F.aggregate(
            block, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"])))

    return F.when(F.rlike(text, pattern), _bound(_bound(parts, _blocks), placed)).otherwise(none)


def scan(docs: DataFrame, rules=RULES, doc="doc_id", text="text") -> DataFrame:
    """``docs`` with ``spans``: all secrets, as (start, kind, end) with the
    number of the rule, by start and then by rule."""
    queries = [trigram_query(rule.pattern) for rule in rules]
    wanted = sorted(set().union(*map(trigrams, queries)))
    own = [F.col(f"`{c}`") for c in docs.columns if c != "spans"]
    rows = docs.select(F.struct(*own).alias("kept"), F.col(doc).alias("id"), F.coalesce(text, F.lit("")).alias("content"))
    if wanted:
        found = candidates(postings(docs, wanted, doc, text), rules)
        found = broadcast_if_small(found, store="secret-candidates")
        rows = rows.join(found, rows["id"].eqNullSafe(found["doc"]), "left")
        mask = F.coalesce("rules", F.lit(0))
    else:
        mask = F.lit(0)
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    content = F.col("content")
    spans = [
        rule_spans(content, rule, r) if queries[r] is True
        else F.when(mask.bitwiseAND(F.lit(1 << r)) != 0, rule_spans(content, rule, r)).otherwise(none)
        for r, rule in enumerate(rules)
    ]
    return rows.select("kept.*", F.array_sort(F.concat(*spans)).alias("spans"))


def redact(scanned: DataFrame, text="text", mark="[secret]") -> DataFrame:
    """Replace every span by ``mark``, overlapping spans by one.

    A block of spans cuts its own piece out of the text once, so a text is read once
    a block and not once a span.
    """
    content = F.coalesce(F.col(text), F.lit(""))

    def past(at, block):
        return F.greatest(at, F.coalesce(F.array_max(F.transform(block, lambda s: s["end"])), F.lit(0)))

    def piece(block, at):
        return F.struct(
            block.alias("spans"), at.alias("at"), F.substr(content, at + 1, past(at, block) - at).alias("own"))

    def marked(part):
        def step(acc, span):
            gap = F.substr(part["own"], acc["at"] - part["at"] + 1, span["start"] - acc["at"])
            new = F.struct(span["end"].alias("at"), F.concat(acc["out"], gap, F.lit(mark)).alias("out"))
            longer = F.struct(F.greatest(acc["at"], span["end"]).alias("at"), acc["out"].alias("out"))
            return F.when(span["start"] >= acc["at"], new).otherwise(longer)

        start = F.struct(part["at"].alias("at"), F.lit("").alias("out"))
        return F.aggregate(part["spans"], start, step, lambda acc: acc["out"])

    def pieces(blocks):
        return F.array_join(F.transform(F.zip_with(blocks, _starts(blocks, past), piece), marked), "")

    rest = F.substr(content, past(F.lit(0), F.col("spans")) + 1, F.length(content))
    cleaned = F.concat(_bound(_blocks(F.col("spans")), pieces), rest)
    return scanned.withColumn(text, F.when(F.size("spans") > 0, cleaned).otherwise(F.col(text)))


def joined(spans: Column, rules) -> Column:
    names = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(scanned: DataFrame, rules=RULES) -> DataFrame:
    spans = F.col("spans")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter(spans, lambda s: s["kind"] < len(BASE_RULES))
    return scanned.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(base, rules), 256).alias("base_sha256"), joined(spans, rules).alias("spans"),
    )


def query(spark, sf_dir) -> DataFrame:
    return digest(scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


def _kind_sql(number, rule):
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    least = f"len(regexp_extract_all(text, {pattern}, {rule.group})[i]) >= {rule.least}"
    return f"""
  select doc_id, text, {number} as kind, '{rule.kind}' as name, unnest(list_filter(list_transform(
    range(1, len(w) + 1), lambda i: {{'start': list_sum(list_transform(p[1:i], lambda x: len(x)))
      + coalesce(list_sum(list_transform(w[1:i - 1], lambda x: len(x))), 0), 'size': len(w[i]), 'kept': {least}}}),
    lambda x: x.kept)) as s
  from (select doc_id, text, regexp_extract_all(text, {pattern}, 0) as w, string_split_regex(text, {pattern}) as p
    from texts)"""


ORACLE = (
    "with texts as (select doc_id, coalesce(text, '') as text from documents), found as ("
    + " union all ".join(_kind_sql(i, r) for i, r in enumerate(RULES))
    + f"""), parts as (
  select doc_id, text, kind, cast(s.start as bigint) as start,
    name || ':' || cast(cast(s.start as bigint) as varchar) || ':' || cast(cast(s.start + s.size as bigint) as varchar) as label
  from found)
select t.doc_id, count(*) filter (where kind = 0) as n_assign, count(*) filter (where kind = 1) as n_access,
  count(*) filter (where kind = 2) as n_hex,
  sha256(coalesce(string_agg(label, ',' order by start, kind) filter (where kind < {len(BASE_RULES)}), '')) as base_sha256,
  coalesce(string_agg(label, ',' order by start, kind), '') as spans
from texts t left join parts f on f.doc_id = t.doc_id group by t.doc_id
"""
)
