"""Information-theoretic sanitisation, all in DataFrame and SQL functions.

Personal data are found by patterns. An entity (one e-mail address, one card number) that
occurs in enough different texts is protected: a term t discloses entity e when, counted over
all different texts of the corpus,

    PMI(t; e) = ln(n(t, e) * N / (n(t) * n(e)))  >=  share * ln(N / n(e)),

that is, when knowing t gives away that share of the information in e. In documents with the
entity such terms are spans as well. They are generalised to a placeholder, or removed
where the term never occurs without the entity.

Texts that are equal are brought together once, with the copies combined before they are
shuffled; spans and terms are taken from the different texts. Counts are pre-aggregated; a
frequent entity's rows never meet in one task, and rows of a frequent text are spread.
Work on a text is linear in its length, and grows with the 1.5th power of its matches by cheap
copies of numbers only.

Defined results: a null text is an empty one without spans; texts that are equal count once
in the corpus and get equal spans; an entity's own characters are no terms; documents
without a protected entity get no terms; an empty table gives no rows; null ids are kept; extra
columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinseek.llm import graph
from kinseek.operators.hot_keys import find_hot_keys, lookup_join
from kinseek.runtime import stage

SUPPORT = 3  # different texts that must hold an entity, and a term with it
SHARE = 0.8  # of an entity's information that a term may not disclose
BROADCAST_ROWS = 100_000
BROADCAST_TERMS = 1_000_000  # in the lists that are broadcast together
BLOCK_BITS = 10  # texts are cut at spans by way of blocks of 2**10 characters

# Kinds in their order, and the pattern of each. Quantifiers are possessive
# where no shorter match could follow, so that matching is linear and does not recurse.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",  # shorter runs are dropped anyway
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"\p{L}[\p{L}\p{N}]{2,}+"
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string,gone:boolean>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        x = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return total + F.when(i % 2 == 0, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        size = F.length(_digits(value))
        return F.when(size.between(12, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    if kind in ("card", "phone"):
        return _digits(value)
    return F.lower(value)


def _let(value: Column, use) -> Column:
    """`use(value)` with `value` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, add) -> Column:
    """Running totals of an array, taken in blocks of about the root of its size."""

    def scan(block: Column) -> Column:
        rest = F.slice(block, F.lit(2), F.size(block))
        return F.aggregate(rest, F.slice(block, 1, 1), lambda out, v: F.concat(out, F.array(add(F.element_at(out, -1), v))))

    def onward(parts: Column, ends: Column) -> Column:
        return F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.transform(p, lambda v: add(F.get(ends, i - 1), v))))

    def of(all_values: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(all_values).cast("double"))).cast("int")
        cut = F.transform(F.sequence(F.lit(0), F.size(all_values) - 1, width), lambda k: scan(F.slice(all_values, k + 1, width)))
        last = lambda parts: scan(F.transform(parts, lambda p: F.element_at(p, -1)))
        return F.flatten(_let(cut, lambda parts: _let(last(parts), lambda ends: onward(parts, ends))))

    return F.when(F.size(values) > 0, _let(values, of)).otherwise(values)


def _located(matches: Column, pieces: Column, span, keep) -> Column:
    """Spans of `matches`, which stand between the `pieces` of the text, that pass `keep`."""
    lengths = F.zip_with(pieces, matches, lambda p, m: F.length(p) + F.coalesce(F.length(m), F.lit(0)))

    def placed(ends: Column) -> Column:
        return F.transform(matches, lambda v, i: F.struct(v.alias("v"), F.get(ends, i).alias("end")))

    kept = F.filter(_let(_running(lengths, lambda a, b: a + b), placed), lambda m: keep(m["v"]))
    spans = F.transform(kept, lambda m: span(m["end"] - F.length(m["v"]), m["end"], m["v"]).cast(SPAN))
    return F.when(F.size(matches) > 0, spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def _span(kind: str, rank: int):
    def make(start: Column, end: Column, value: Column) -> Column:
        return F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), _entity(kind, value).alias("value"), F.lit(False).alias("gone")
        )

    return make


def with_spans(docs: DataFrame) -> DataFrame:
    """`docs` (with `text` not null) and `_spans`: personal data by pattern, in order."""
    signs = {"email": F.col("text").contains("@"), "phone": F.col("text").contains("+"), "ip": F.col("text").rlike("[0-9]\\.[0-9]"), "card": F.col("text").rlike("[0-9]")}
    none = F.array().cast("array<string>")
    for kind, pattern in PATTERNS.items():
        docs = docs.withColumn(f"_m_{kind}", F.when(signs[kind], F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    for kind, pattern in PATTERNS.items():
        docs = docs.withColumn(f"_p_{kind}", F.when(F.size(f"_m_{kind}") > 0, F.split("text", pattern, -1)).otherwise(none))
    found = [
        _located(F.col(f"_m_{kind}"), F.col(f"_p_{kind}"), _span(kind, rank), lambda v, k=kind: _valid(k, v)) for rank, kind in enumerate(PATTERNS)
    ]
    return docs.withColumn("_spans", F.array_sort(F.concat(*found))).drop(*[f"_{x}_{kind}" for kind in PATTERNS for x in "mp"])


def _between(blocks: Column, start: Column, end: Column) -> Column:
    """Characters from `start` to `end` of a text that is cut into blocks."""
    first = F.shiftright(start, BLOCK_BITS)
    held = F.array_join(F.slice(blocks, first + 1, F.shiftright(end - 1, BLOCK_BITS) - first + 1), "")
    return F.when(end > start, F.substring(held, start - F.shiftleft(first, BLOCK_BITS) + 1, end - start)).otherwise("")


def _replaced(text: Column, spans: Column, put, put_more) -> Column:
    """The text with `put(span)` for its sorted spans. For a span that starts before the end
    of an earlier one there is `put_more(span, that end)`."""

    def rebuilt(blocks: Column, reach: Column) -> Column:
        def part(s: Column, i: Column) -> Column:
            at = F.when(i == 0, 0).otherwise(F.get(reach, i - 1))
            fresh = F.concat(_between(blocks, at, s["start"]), put(s))
            return F.when(s["start"] >= at, fresh).otherwise(put_more(s, at))

        return F.concat(F.array_join(F.transform(spans, part), ""), _between(blocks, F.element_at(reach, -1), F.length(text)))

    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << BLOCK_BITS}}}"), F.lit(0))
    reach = _running(F.transform(spans, lambda s: s["end"]), F.greatest)
    return F.when(F.size(spans) == 0, text).otherwise(_let(cut, lambda blocks: _let(reach, lambda r: rebuilt(blocks, r))))


def _masked(text: Column, spans: Column) -> Column:
    """The text with blanks in place of its spans."""
    blank = F.lit(" ")
    return _replaced(
        text, spans, lambda s: F.repeat(blank, s["end"] - s["start"]), lambda s, at: F.repeat(blank, F.greatest(s["end"] - at, F.lit(0)))
    )


def _some(df: DataFrame, listed: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join with a list, broadcast where it is short enough."""
    return df.join(F.broadcast(listed) if graph.small_enough(listed, BROADCAST_ROWS) else listed, keys, how)


def _few(terms: DataFrame) -> bool:
    """Whether the term lists of all texts are small enough to broadcast."""
    if not graph.small_enough(terms, BROADCAST_ROWS):
        return False
    return (terms.agg(F.sum(F.size("terms"))).first()[0] or 0) <= BROADCAST_TERMS


def _with_terms(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """`rows` with the term lists of their texts; rows of a frequent text are spread."""
    if _few(terms):
        return rows.join(F.broadcast(terms), "_text", "left")
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    return lookup_join(salted, terms, find_hot_keys(rows.select("_text"), ["_text"]), "left", ["_salt"]).drop("_salt")


def _texts(docs: DataFrame) -> DataFrame:
    """`_text, text, _spans`, staged: each different text once."""
    return stage(with_spans(docs.select("_text", "text").dropDuplicates(["_text"])))


def _terms_of(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def disclosing_terms(texts: DataFrame, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """`_text, terms, gone`: by hash of a text with a protected entity, its terms to generalise
    and those to remove. `texts` has each different `text` once, `_text` (its hash) and `_spans`."""
    entities_of = F.array_distinct(F.transform("_spans", lambda s: F.concat_ws(":", s["kind"], s["value"])))
    pairs = texts.where(F.size("_spans") > 0).select("_text", F.explode(entities_of).alias("_e"))
    entities = stage(pairs.groupBy("_e").agg(F.count(F.lit(1)).alias("_ne")).where(f"_ne >= {support}"))
    protected = stage(_some(pairs, entities, ["_e"]))
    own = _some(texts.where(F.size("_spans") > 0), protected.select("_text").distinct(), ["_text"], "left_semi")
    own = stage(own.select("_text", _terms_of(_masked(F.col("text"), F.col("_spans"))).alias("_terms")))
    met = protected.join(own, "_text").select("_text", "_e", "_ne", F.explode("_terms").alias("_t"))
    together = met.groupBy("_t", "_e").agg(F.count(F.lit(1)).alias("_nte"), F.first("_ne").alias("_ne")).where(f"_nte >= {support}")
    total = texts.count()
    known = F.log(F.lit(float(max(total, 1))) / F.col("_ne"))
    pmi = F.log(F.col("_nte") * F.lit(float(total)) / (F.col("_nt") * F.col("_ne")))
    tells = (known > 0) & (pmi >= share * known - 1e-9)
    # A term is in no fewer texts than here, so most common words can be left out at once.
    here = own.select(F.explode("_terms").alias("_t")).groupBy("_t").agg(F.count(F.lit(1)).alias("_nt"))
    together = stage(together.join(here, "_t").where(tells).drop("_nt"))
    asked = stage(together.select("_t").distinct())
    everywhere = texts.select(F.explode(_terms_of(F.col("text"))).alias("_t"))
    if graph.small_enough(asked, BROADCAST_ROWS):
        everywhere = everywhere.join(F.broadcast(asked), "_t", "left_semi")
    counts = everywhere.groupBy("_t").agg(F.count(F.lit(1)).alias("_nt"))
    telling = together.join(counts, "_t").where(tells).select("_t", "_e", (F.col("_nte") >= F.col("_nt")).alias("_gone"))
    telling = stage(telling)
    return (
        _some(met, telling, ["_t", "_e"])
        .groupBy("_text")
        .agg(F.collect_set("_t").alias("terms"), F.collect_set(F.when(F.col("_gone"), F.col("_t"))).alias("gone"))
    )


def _term_spans() -> Column:
    """Spans of the `terms` of a text, outside of its personal data."""
    def span(start: Column, end: Column, value: Column) -> Column:
        return F.struct(
            start.alias("start"), F.lit(len(PATTERNS)).alias("rank"), end.alias("end"), F.lit("term").alias("kind"), F.lower(value).alias("value"),
            F.array_contains("gone", F.lower(value)).alias("gone"),
        )

    return _located(F.col("_tm"), F.col("_tp"), span, lambda v: F.array_contains("terms", F.lower(v)))


def _with_term_spans(docs: DataFrame) -> DataFrame:
    masked = docs.withColumn("_masked", _masked(F.col("text"), F.col("_spans")))
    split = masked.withColumn("_tm", F.regexp_extract_all("_masked", F.lit(TERM), F.lit(0))).withColumn("_tp", F.split("_masked", TERM, -1))
    return split.withColumn("_term_spans", _term_spans()).drop("_masked", "_tm", "_tp")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _prepared(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whole as `_all`, their `text` without nulls and its hash `_text`."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all"), text.alias("text"), F.xxhash64(text).alias("_text"))


def _count(kind: str) -> Column:
    return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long")


def find_personal_data(docs: DataFrame, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """`doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms` of every row of `docs`."""
    given = _prepared(docs.select("doc_id", "text"))
    texts = _texts(given)
    terms = stage(disclosing_terms(texts, support, share))
    flagged = texts.where(F.size("_spans") > 0).join(F.broadcast(terms) if _few(terms) else terms, "_text")
    extra = _with_term_spans(flagged).select("_text", "_term_spans")
    every = F.array_sort(F.concat("_spans", F.coalesce("_term_spans", F.array().cast(f"array<{SPAN}>"))))
    counts = [_count(kind).alias(f"n_{kind}") for kind in PATTERNS]
    found = stage(texts.select("_text", "_spans").join(extra, "_text", "left").select(
        "_text", *counts, F.sha2(_joined(F.col("_spans")), 256).alias("base_sha256"), _joined(every).alias("spans"),
        F.coalesce(F.size("_term_spans"), F.lit(0)).cast("long").alias("n_terms"),
    ))
    rows = stage(given.select("_all.doc_id", "_text"))
    copies = rows.groupBy("_text").agg(F.count(F.lit(1)).alias("_rows"))
    told = lookup_join(rows, found, find_hot_keys(copies, ["_text"], "_rows"), "left", ["doc_id"])
    return told.drop("_text")


def _rewritten(text: Column, spans: Column) -> Column:
    """The text with placeholders for its spans; overlapping ones become one."""
    put = lambda s: F.when(s["gone"], F.lit("")).otherwise(F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
    return _replaced(text, spans, put, lambda s, at: F.lit(""))


def sanitised(docs: DataFrame, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """`docs` with placeholders in `text` for personal data and for terms that disclose them.

    Texts without spans stay as they are, null ones too; all columns stay, whatever their names.
    """
    given = _prepared(docs)
    terms = stage(disclosing_terms(_texts(given), support, share))
    told = with_spans(_with_terms(given, terms))
    plain = told.withColumn("_masked", F.when(F.col("terms").isNotNull(), _masked(F.col("text"), F.col("_spans"))))
    none = F.array().cast("array<string>")
    split = plain.withColumn("_tm", F.when(F.col("terms").isNotNull(), F.regexp_extract_all("_masked", F.lit(TERM), F.lit(0))).otherwise(none)).withColumn(
        "_tp", F.when(F.col("terms").isNotNull(), F.split("_masked", TERM, -1)).otherwise(none)
    )
    both = split.withColumn("_spans", F.array_sort(F.concat("_spans", _term_spans())))
    text = F.when(F.size("_spans") == 0, F.col("_all.text")).otherwise(_rewritten(F.col("text"), F.col("_spans")))
    return both.select(*[(text if c == "text" else F.col(f"_all.`{c}`")).alias(c) for c in docs.columns])
