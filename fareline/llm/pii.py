"""Personal data: patterns, and terms that reveal a protected entity, all in Spark functions.

Every value that the patterns find is a protected entity e. Its information content is
IC(e) = log2(N / n(e)) over N documents. A term t of the documents with e reveals
PMI(e, t) = log2(N n(e, t) / (n(e) n(t))) of it, where n(e, t) counts documents with both
anywhere and n(t) all documents with t. As n(e, t) <= n(t), the share PMI / IC is
at most 1, and 1 means that the term occurs with that entity only. Above one threshold a
term is generalised, above a higher one removed. A pair must be seen in several different
texts, as a single text is no estimate.

Most values occur in one text only. So the classes of a value are entities as well: its
kind, and the domain of an e-mail, the first three parts of an ip, the issuer of a card,
the country and area of a phone. Among the many terms of a class some are always with it
by chance, so n(e, t) / n(t) is replaced by the lower end of its Wilson interval, in which
copies of a text are no further evidence.

Patterns are written with possessive repeats and look-behind, which match the same spans
as the plain ones but need no more than linear time and no stack on long runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import durable, written

_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Whole runs of 14 to 19 digits; a run of any other length can't be a card.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
_WORD = r"\p{L}[\p{L}\p{N}]{2,}+"
_CHUNK = r"(?s).{1,512}+[\p{L}\p{N}]*+"

#: Texts that must show a pair, and the two thresholds.
SUPPORT, GENERALISE, REMOVE = 2, 0.5, 0.9
#: Standard errors below the estimate for a class: one term in some millions by chance.
SIGMAS = 5.0

_FOUND = "array<struct<start:int,end:int,value:string>>"
_SPANS = "array<struct<start:int,place:int,end:int,kind:string,value:string>>"


def matches(text: Column, pattern: str) -> Column:
    """Start, end (in code points) and value of every match, from the gaps between them."""
    parts = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")),
    )

    def step(so_far: Column, part: Column) -> Column:
        start = so_far["at"] + part["gap"]
        end = start + F.coalesce(F.length(part["value"]), F.lit(0))
        one = F.array(F.struct(start.alias("start"), end.alias("end"), part["value"].alias("value")))
        found = F.when(part["value"].isNull(), so_far["found"]).otherwise(F.concat(so_far["found"], one))
        return F.struct(end.alias("at"), found.alias("found"))

    none = F.from_json(F.lit("[]"), _FOUND)
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))
    found = F.aggregate(parts, start, step, lambda so_far: so_far["found"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def base_spans(text: Column) -> Column:
    """Spans of all kinds by start, then in the order of KINDS."""
    def kept(place: int, pattern: str, check: Callable[[Column], Column]) -> Column:
        found = F.filter(matches(text, pattern), lambda m: check(m["value"]))
        names = F.lit(place).alias("place"), F.lit(KINDS[place]).alias("kind")
        return F.transform(found, lambda m: F.struct(m["start"], names[0], m["end"], names[1], m["value"]))

    return F.array_sort(
        F.concat(
            kept(0, EMAIL, lambda v: F.lit(True)),
            kept(1, IP, lambda v: v.rlike(IP_PARTS)),
            kept(2, CARD, lambda v: F.call_function("luhn_check", _digits(v))),
            kept(3, PHONE, lambda v: F.length(_digits(v)).between(10, 15)),
        )
    )


def _entities(span: Column) -> Column:
    """The exact value as kind:value, then its classes: kind/part and kind."""
    kind = span["kind"]
    value = F.when(kind.isin("card", "phone"), _digits(span["value"])).otherwise(F.lower(span["value"]))
    part = (
        F.when(kind == "email", F.regexp_extract(value, "@(.*)$", 1))
        .when(kind == "ip", F.regexp_extract(value, r"^(.*)\.", 1))
        .when(kind == "card", F.substring(value, 1, 6))
        .otherwise(F.regexp_extract(value, "^(.*).{7}$", 1))
    )
    return F.array(F.concat(kind, F.lit(":"), value), F.concat(kind, F.lit("/"), part), kind)


def _least_rate(n_both: Column, n_term: Column, texts: Column) -> Column:
    """Lower end of the Wilson interval of n_both / n_term, on as many trials as give `texts` hits."""
    rate = n_both / n_term
    per_trial = F.lit(SIGMAS**2) * rate / texts
    spread = F.sqrt(per_trial * rate * (1 - rate) + per_trial * per_trial / 4)
    return (rate + per_trial / 2 - spread) / (1 + per_trial)


def _keys(id_col: str, text: Column) -> list[Column]:
    """What names a row: its id and a 128-bit digest of its text; equal rows share their spans."""
    return [F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.unhex(F.md5(text)).alias("_hash")]


def _distinct_terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), F.lower))


def _term_spans(texts: DataFrame) -> DataFrame:
    """(_hash, start, end, share) of every place of the terms in `shares` in _text.

    Words are found a chunk at a time, which ends where a run of letters and digits does;
    so long texts take no more than linear time, but for the sums of chunk lengths.
    """
    chunks = F.regexp_extract_all("_text", F.lit(_CHUNK), F.lit(0))
    starts = F.aggregate(
        F.transform("chunks", F.length),
        F.array(F.lit(0)),
        lambda so_far, size: F.concat(so_far, F.array(F.element_at(so_far, -1) + size)),
    )
    parts = (
        texts.select("_hash", "shares", chunks.alias("chunks"))
        .select("_hash", "shares", F.explode(F.arrays_zip("chunks", starts.alias("at"))).alias("c"))
        .where(F.col("c.chunks").isNotNull())
    )
    words = parts.select("_hash", "shares", "c.at", F.explode(matches(F.col("c.chunks"), _WORD)).alias("w"))
    return words.select(
        "_hash",
        (F.col("at") + F.col("w.start")).alias("start"),
        (F.col("at") + F.col("w.end")).alias("end"),
        F.col("shares")[F.lower("w.value")].alias("share"),
    ).where(F.col("share").isNotNull())


def disclosing_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    support: int = SUPPORT,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """(id_col, _id, _hash, base, terms) for every row; durable.

    base: the spans of the patterns. terms: spans of revealing terms wherever they stand in
    a document with the entity, with their share of disclosure as value and the action as
    kind (generalise or remove); none overlaps a base span. Null and empty texts have no
    spans. Rows that repeat an id and its text have the same spans and count once for pairs.
    All counts are over the whole table, a document's distinct terms against its distinct
    entities; every aggregation combines before its shuffle. Only the two columns are read,
    whatever others are called; an empty table gives no rows. Values of a single text take
    no part in pairs, as they can't have the support. Only a document's own entities and
    its revealing terms are gathered.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = docs.select(F.col(id_col).alias("doc_id"), *_keys(id_col, text), text.alias("_text")).withColumn(
        "base", base_spans(F.col("_text"))
    )
    with_text = F.when(F.size("base") > 0, F.col("_text"))
    rows = durable(spans.select("doc_id", "_id", "_hash", "base", with_text.alias("_text")))
    total = float(rows.count())
    marked = rows.where(F.size("base") > 0)

    each = F.array_distinct(F.flatten(F.transform("base", _entities)))
    mentions = marked.select("_id", "_hash", F.explode(each).alias("entity")).distinct()
    mentions = durable(mentions.groupBy("entity", "_hash").agg(F.count(F.lit(1)).alias("n")))
    entities = mentions.groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count(F.lit(1)).alias("texts"))
    entities = durable(entities.where((F.col("texts") >= support) & (F.col("n_entity") < total)).drop("texts"))
    repeated = mentions.join(entities, "entity", "left_semi").groupBy("_hash").agg(
        F.collect_list("entity").alias("entities"), F.first("n").alias("n")
    )
    texts = durable(marked.select("_hash", "_text").dropDuplicates(["_hash"]).join(repeated, "_hash"))

    # A document's entities beside its terms; what the pairs reveal joins them again below.
    with_terms = written(texts.select("_hash", "n", "entities", F.explode(_distinct_terms(F.col("_text"))).alias("term")))
    both = with_terms.select("_hash", "n", "term", F.explode("entities").alias("entity"))
    pairs = (
        both.groupBy("entity", "term")
        .agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("texts"))
        .where(F.col("texts") >= support)
    )
    terms = docs.select(F.explode(_distinct_terms(F.col(text_col))).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n_term")
    )
    rate = F.when(F.col("entity").contains(":"), F.col("n_both") / F.col("n_term")).otherwise(
        _least_rate(F.col("n_both"), F.col("n_term"), F.col("texts"))
    )
    share = F.log2(F.lit(total) * rate / F.col("n_entity")) / F.log2(F.lit(total) / F.col("n_entity"))
    revealing = durable(
        pairs.join(entities, "entity")
        .join(terms, "term")
        .select("entity", "term", share.alias("share"))
        .where(F.col("share") >= generalise)
    )
    shares = (
        both.join(revealing, ["entity", "term"])
        .groupBy("_hash", "term")
        .agg(F.max("share").alias("share"))
        .groupBy("_hash")
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("shares"))
    )
    found = _term_spans(texts.select("_hash", "_text").join(shares, "_hash"))
    kind = F.when(F.col("share") >= remove, "remove").otherwise("generalise")
    span = F.struct(
        "start", F.lit(len(KINDS)).alias("place"), "end", kind.alias("kind"), F.col("share").cast("string").alias("value")
    )
    by_text = found.groupBy("_hash").agg(F.array_sort(F.collect_list(span)).alias("terms"))
    none = F.from_json(F.lit("[]"), _SPANS)
    apart = F.filter(
        F.coalesce("terms", none),
        lambda t: ~F.exists("base", lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"])),
    )
    kept = ["doc_id", "_id", "_hash", "base"]
    with_terms = marked.select(*kept).join(by_text, "_hash", "left").select(*kept, apart.alias("terms"))
    without = rows.where(F.size("base") == 0).select(*kept, none.alias("terms"))
    return durable(with_terms.unionByName(without).withColumnRenamed("doc_id", id_col))


def span_digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by kind, the digest of the base spans and all spans as a string."""
    named = lambda column: F.array_join(
        F.transform(
            column,
            lambda s: F.concat_ws(
                ":", F.when(s["place"] < len(KINDS), s["kind"]).otherwise(TERM), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda k: k == F.lit(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return spans.select(
        id_col,
        *counts,
        F.sha2(named(F.col("base")), 256).alias("base_sha256"),
        named(F.array_sort(F.concat("base", "terms"))).alias("spans"),
    )


def _rewritten(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its class."""
    label = lambda s: (
        F.when(s["kind"] == "remove", F.lit("")).when(s["kind"] == "generalise", F.lit("[TERM]")).otherwise(
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        )
    )

    def step(so_far: Column, s: Column) -> Column:
        gap = F.substring(text, so_far["at"] + 1, s["start"] - so_far["at"])
        parts = F.when(s["start"] < so_far["at"], so_far["parts"]).otherwise(
            F.concat(so_far["parts"], F.array(gap, label(s)))
        )
        return F.struct(F.greatest(so_far["at"], s["end"]).alias("at"), parts.alias("parts"))

    start = F.struct(F.lit(0).alias("at"), F.from_json(F.lit("[]"), "array<string>").alias("parts"))
    return F.aggregate(
        spans,
        start,
        step,
        lambda so_far: F.concat(F.array_join(so_far["parts"], ""), F.substring(text, so_far["at"] + 1, F.length(text))),
    )


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """docs with personal data replaced by its kind and revealing terms by [TERM] or nothing.

    All rows and columns stay, in any order; only text_col changes, and only where it has
    spans. Null texts stay null; columns of any name are carried along as they are. Rows
    without personal data aren't shuffled.
    """
    spans = disclosing_spans(docs, id_col, text_col, **limits)
    text = F.coalesce(F.col(text_col), F.lit(""))
    has_any = F.lit(False)
    for pattern in (EMAIL, IP, CARD, PHONE):
        has_any = has_any | text.rlike(pattern)
    found = spans.where(F.size("base") > 0).groupBy("_id", "_hash").agg(
        F.first(F.array_sort(F.concat("base", "terms"))).alias("_spans")
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.where(has_any).select(row, *_keys(id_col, text)).join(found, ["_id", "_hash"], "left")
    old = F.col("_row")[text_col]
    new = F.when(F.col("_spans").isNull(), old).otherwise(_rewritten(F.coalesce(old, F.lit("")), F.col("_spans")))
    changed = keyed.select(*(new.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns))
    return docs.where(~has_any).unionByName(changed)
