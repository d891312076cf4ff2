"""Personal data, and the terms around it that give it away.

Four patterns find protected entities: mail and IP addresses, card and phone
numbers. What stands around them is judged by information: over the corpus's
distinct texts, a term t reveals an entity e by

    log(N n(t, e) / (n(t) n(e))) / log(N / n(e)),

the pointwise mutual information as a share of the entity's own information:
nothing if they are independent, one if t never occurs without e. n(t, e) counts
texts in which t stands within WINDOW words of e. A term counts as disclosing if
that share reaches a threshold for some entity, and if it was seen near the entity
in SUPPORT different surroundings, so that one passage that many texts repeat is
one observation. Every occurrence of such a term in any text is a span: it is
generalised to its shape from GENERALISE on, and removed from REMOVE on.

The counts cover the whole corpus. Surroundings of entities are rows (entity, term,
surroundings, text), made distinct before they are counted, so that no entity, term
or group of copies gathers in one task. A term's count near entities bounds its
count from below, which leaves few candidates; only those are counted in all texts.
They go into every task while they measure small, and a task that has met one in more
texts than the threshold allows names no further ones; beyond that size they are
joined to all words of the texts. Texts are never shuffled while the terms found in them measure
small enough for a broadcast.

Defined cases: a null text is empty and has no spans; texts with equal 64-bit hashes
count as one, repeated rows and ids each get their spans; an entity that all texts
hold is not given away by anything; an empty table gives no rows; further columns
stay, but for one of the name of the result, which is replaced. All patterns take
time in proportion to the text.
"""

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import BROADCAST_BYTES, materialize, measured_bytes

KINDS = ("email", "ip", "card", "phone")  # fixed values: the base kinds as listed
TERM = len(KINDS)
WINDOW = 8
SUPPORT = 3
REMEMBERED = 1000  # texts of one term that a task remembers, to leave out what can't matter
GENERALISE, REMOVE = 0.8, 0.95

LOCAL = "A-Za-z0-9._%+-"
MAIL_NAME = re.compile(rf"(?<![{LOCAL}])[{LOCAL}]++@")  # a whole run, so that no run is read twice
MAIL_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORD = re.compile(r"\w{2,}")
DIGIT = re.compile(r"[0-9]")

SPANS = "array<struct<kind:int,start:int,end:int,disclosure:double>>"
NEAR = "entity string, term string, surroundings bigint, text bigint"


def _mails(text):
    last = 0
    for m in MAIL_NAME.finditer(text):
        at = m.end()
        if last < at - 1 and (host := MAIL_HOST.match(text, at)):
            yield max(m.start(), last), host.end()
            last = host.end()


def _addresses(text):
    for m in ADDRESS.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts):
            yield m.span()


def luhn(digits):
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[::-2]))) % 10 == 0


def _cards(text):
    for m in CARD.finditer(text):
        digits = DIGIT.findall(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text):
    for m in PHONE.finditer(text):
        if 9 <= len(DIGIT.findall(m[0])) <= 15:
            yield m.span()


def base_spans(text):
    """(kind, start, end) of all protected entities, by kind, then start."""
    found = [(0, *s) for s in _mails(text)] if "@" in text else []
    if DIGIT.search(text):
        for kind, spans in ((1, _addresses), (2, _cards), (3, _phones)):
            found += [(kind, *s) for s in spans(text)]
    return found


def entity(kind, value):
    """One name for all spellings of an entity."""
    if kind >= 2:
        value = "".join(DIGIT.findall(value))
    elif kind == 1:
        value = ".".join(p.lstrip("0") or "0" for p in value.split("."))
    return f"{KINDS[kind]}:{value.lower()}"


def words_outside(text, spans):
    """(start, end, term) of the words that no span touches."""
    merged = []
    for start, end in sorted((s, e) for _, s, e in spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    starts = [s for s, _ in merged]
    for m in WORD.finditer(text):
        at = bisect_left(starts, m.end()) - 1
        if at < 0 or merged[at][1] <= m.start():
            yield m.start(), m.end(), m[0].lower()


def surroundings(text):
    """(entity, term, hash of the surroundings) of a text, each once."""
    import xxhash

    spans = base_spans(text)
    if not spans:
        return set()
    words = list(words_outside(text, spans))
    starts, ends = [w[0] for w in words], [w[1] for w in words]
    found = set()
    for kind, start, end in spans:
        before, after = bisect_right(ends, start), bisect_left(starts, end)
        near = [w[2] for w in words[max(0, before - WINDOW):before] + words[after:after + WINDOW]]
        name, place = entity(kind, text[start:end]), xxhash.xxh64_intdigest("\n".join(near)) - (1 << 63)
        found.update((name, term, place) for term in near)
    return found


def _hashed(docs, text):
    return docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("content")).select(
        "content", F.xxhash64("content").alias("text"))


def near_entities(docs: DataFrame, text="text") -> DataFrame:
    """NEAR: what stands near the protected entities of each text."""

    def run(batches):
        for batch in batches:
            hashes = batch.column(1).to_pylist()
            rows = [(*row, h) for t, h in zip(batch.column(0).to_pylist(), hashes) for row in sorted(surroundings(t))]
            columns = zip(*rows) if rows else [()] * 4
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            names = ["entity", "term", "surroundings", "text"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return _hashed(docs, text).mapInArrow(run, NEAR)


def _distinct(df, by, what, name):
    """How many values of ``what`` each group has; no group meets in one task before
    its rows are distinct and counted in part."""
    return df.select(*by, what).distinct().groupBy(*by).agg(F.count("*").alias(name))


def _share(n_texts, near, term, own):
    """The share of an entity's information that a term gives."""
    total = F.lit(float(n_texts))
    information = F.log(total / F.col(own))
    return F.when(information > 0, F.log(total * F.col(near) / (F.col(term) * F.col(own))) / information).otherwise(0.0)


def candidates(near: DataFrame, n_texts: int, least=GENERALISE) -> DataFrame:
    """(entity, term, n_near, n_entity, most) that may reach the threshold: a term occurs
    in at least as many texts as it does near any entity, and in ``most`` at most."""
    pair = ["entity", "term"]
    seen = _distinct(near, pair, "surroundings", "support").filter(F.col("support") >= SUPPORT)
    pairs = _distinct(near, pair, "text", "n_near").join(seen, pair)
    pairs = pairs.join(_distinct(near, ["entity"], "text", "n_entity"), "entity")
    pairs = pairs.join(_distinct(near, ["term"], "text", "n_least"), "term")
    pairs = pairs.withColumn("bound", _share(n_texts, "n_near", "n_least", "n_entity"))
    # the most texts in which the term may occur and still reach the threshold, rounded up
    total, own = F.lit(float(n_texts)), F.col("n_entity")
    most = F.ceil(total * F.col("n_near") / (own * F.pow(total / own, F.lit(least)))) + 1
    return pairs.filter(F.col("bound") >= least).select(*pair, "n_near", "n_entity", most.alias("most"))


def occurrences(docs: DataFrame, terms: DataFrame, text="text", limit=BROADCAST_BYTES) -> DataFrame:
    """(text, term), each once: the texts in which the given terms (term, most) occur.

    A term that occurs in more texts than ``most`` may lack some of them: once a task
    alone has seen more, what it still finds would change nothing.
    """
    wanted = None
    # as Python holds the terms, and the texts it remembers of each
    held = measured_bytes(terms) * 4 + (terms.agg(F.sum(F.least("most", F.lit(REMEMBERED)) * 64)).first()[0] or 0)
    if held <= limit:
        wanted = {r["term"]: r["most"] for r in terms.collect()}

    def run(batches):
        seen = {}  # the texts of terms that have not yet exceeded their bound; None for others

        def new(term, place):
            most = wanted[term]
            if most > REMEMBERED:
                return True
            places = seen.setdefault(term, set())
            if places is None or place in places:
                return False
            places.add(place)
            if len(places) > most:
                seen[term] = None
            return True

        for batch in batches:
            places, found = [], []
            for t, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = {w.lower() for w in set(WORD.findall(t))}
                here = words if wanted is None else [w for w in words & wanted.keys() if new(w, h)]
                places += [h] * len(here)
                found += here
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(found, pa.string())], names=["text", "term"])

    pairs = _hashed(docs, text).mapInArrow(run, "text bigint, term string")
    if wanted is None:
        pairs = pairs.join(terms, "term", "left_semi").select("text", "term")
    return pairs.distinct()


def disclosing_terms(docs: DataFrame, text="text", limit=BROADCAST_BYTES, least=GENERALISE):
    """(terms, places): the disclosing terms (term, disclosure) of the corpus, and the
    texts (hash, terms) in which they occur. None, None if there are none."""
    near = materialize(near_entities(docs, text), "near-entities")
    n_texts = _hashed(docs, text).select("text").distinct().count()
    pairs = materialize(candidates(near, n_texts, least), "term-candidates")
    if pairs.isEmpty():
        return None, None
    bounds = pairs.groupBy("term").agg(F.max("most").alias("most"))
    places = materialize(occurrences(docs, bounds, text, limit), "term-occurrences")
    counts = places.groupBy("term").agg(F.count("*").alias("n_term"))
    shares = pairs.join(counts, "term").withColumn("share", _share(n_texts, "n_near", "n_term", "n_entity"))
    terms = shares.groupBy("term").agg(F.max("share").alias("disclosure")).filter(F.col("disclosure") >= least)
    terms = materialize(terms, "disclosing-terms")
    found = places.join(terms, "term").groupBy(F.col("text").alias("_hash")).agg(
        F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("_terms"))
    return terms, materialize(found, "texts-with-terms")


def _spans(texts: pa.Array, terms: pa.Array) -> pa.Array:
    out = []
    for text, own in zip(texts.to_pylist(), terms.to_pylist()):
        base = base_spans(text)
        found = [(k, s, e, None) for k, s, e in base]
        if own:
            shares = dict(own)
            found += [(TERM, s, e, shares[w]) for s, e, w in words_outside(text, base) if w in shares]
        out.append([dict(zip(("kind", "start", "end", "disclosure"), x)) for x in found])
    return pa.array(out, pa.list_(pa.struct([
        ("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("disclosure", pa.float64())])))


def scan(docs: DataFrame, text="text", name="spans", limit=BROADCAST_BYTES, least=GENERALISE) -> DataFrame:
    """``docs`` with all spans as ``name``: (kind, start, end, disclosure) by kind as
    listed, terms last, then by start; disclosure is null for base kinds."""
    _, places = disclosing_terms(docs, text, limit, least)
    own = [F.col(f"`{c}`") for c in docs.columns if c != name]
    rows = docs.select(F.struct(*own).alias("_kept"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    none = F.lit(None).cast("map<string,double>")
    if places is None:
        rows = rows.withColumn("_terms", none)
    else:
        size = F.aggregate(F.map_keys("_terms"), F.lit(32), lambda n, t: n + F.octet_length(t) + 24)
        if (places.agg(F.sum(size.cast("bigint"))).first()[0] or 0) <= limit:
            places = F.broadcast(places)
        rows = rows.withColumn("_hash", F.xxhash64("_text")).join(places, "_hash", "left")
    return rows.select("_kept.*", F.arrow_udf(_spans, SPANS)("_text", "_terms").alias(name))


def _cleaned(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, own in zip(texts.to_pylist(), spans.to_pylist()):
        if not own:
            out.append(text)
            continue
        parts, last = [], 0
        for span in sorted(own, key=lambda s: (s["start"], -s["end"])):
            if span["start"] >= last:
                parts += [text[last:span["start"]], _general(text[span["start"]:span["end"]], span)]
            last = max(last, span["end"])
        out.append("".join(parts) + text[last:])
    return pa.array(out, pa.string())


def _general(value, span):
    """What stands in a span's place: its kind, or for a term its shape or nothing."""
    if span["kind"] < TERM:
        return f"[{KINDS[span['kind']]}]"
    if span["disclosure"] >= REMOVE:
        return ""
    return "[code]" if DIGIT.search(value) else "[name]" if value[:1].isupper() else "[term]"


def sanitise(scanned: DataFrame, text="text", name="spans") -> DataFrame:
    """The texts with entities and disclosing terms generalised or removed; spans
    that overlap are replaced as one, by the first."""
    return scanned.withColumn(text, F.arrow_udf(_cleaned, "string")(F.col(f"`{text}`"), F.col(name)))


def joined(spans) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, "term")])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(scanned: DataFrame) -> DataFrame:
    spans = F.col("spans")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

    return scanned.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(joined(F.filter(spans, lambda s: s["kind"] < TERM)), 256).alias("base_sha256"), joined(spans).alias("spans"),
    )


def query(spark, sf_dir) -> DataFrame:
    return digest(scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
