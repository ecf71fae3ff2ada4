"""How far sources diverge in their words, with texts of words fetched last.

Tasks count the words of their documents by language and source, and name each by a
digest of fixed width. Only digests and counts are shuffled: to count, to find the words
that enough documents of a language hold, to compare sources and to choose the words
that are reported. Beside that, the smallest and the greatest text of each digest are
found; where they differ, several words share the digest, which is then split by their
texts in a further reading. The texts of all other words are joined back to what is
reported only.

All arithmetic is on integers: decimals where a product or a sum may not fit a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareline.llm.common import written

LEAST_DOCS, TOP = 3, 200
SCALE = 1_000_000_000
DIGEST_BITS = 64
#: Bytes of text whose words a task counts together.
HELD_BYTES = 1 << 23

_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256)], np.uint8)


class Terms:
    """The words of some texts: runs of ASCII letters and characters beyond ASCII, only A-Z lower-cased.

    texts are their distinct ones; each occurrence has the place of its text among them
    and the document that it is in.
    """

    def __init__(self, column: pa.Array) -> None:
        column = pa.concat_arrays([column.cast(pa.large_string())])
        _, offsets, data = column.buffers()
        folded = _FOLD[np.frombuffer(data, np.uint8)] if data else np.empty(0, np.uint8)
        folded = pa.LargeStringArray.from_buffers(len(column), offsets, pa.py_buffer(folded))
        split = pc.ascii_split_whitespace(folded)
        words = split.flatten().dictionary_encode()
        self.texts = words.dictionary.cast(pa.large_binary())
        place = words.indices.to_numpy(zero_copy_only=False)
        document = np.repeat(np.arange(len(column), dtype=np.int64), np.diff(split.offsets.to_numpy()))
        # Blanks at a text's ends leave empty words.
        real = np.append(pc.binary_length(self.texts).to_numpy(zero_copy_only=False) > 0, False)[place]
        self.place, self.document = place[real], document[real]

    def digests(self, bits: int) -> np.ndarray:
        """The first bits of a 64-bit hash of each distinct text, as longs."""
        made = np.fromiter(map(xxhash.xxh3_64_intdigest, self.texts.to_pylist()), np.uint64, len(self.texts))
        return (made >> np.uint64(64 - bits)).view(np.int64)

    def counts(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Group, place, documents and occurrences of the words of each group of documents."""
        kinds = max(1, len(self.texts))
        keys, n = np.unique(group[self.document] * kinds + self.place, return_counts=True)
        once = np.unique(self.document * kinds + self.place)
        _, docs = np.unique(group[once // kinds] * kinds + once % kinds, return_counts=True)
        return keys // kinds, keys % kinds, docs, n


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about HELD_BYTES of text, or one longer text."""
    sizes = pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for at, size in enumerate(sizes):
        if at > start and held + size > HELD_BYTES:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def _from_texts(docs: DataFrame, columns: list[str], schema: str, make: Callable[[pa.RecordBatch], list]) -> DataFrame:
    """Rows made from the text, language and source of many documents at a time; nulls read as empty."""
    names = [field.split()[0] for field in schema.split(", ")]
    read = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(f"c{n}") for n, c in enumerate(columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                yield pa.RecordBatch.from_arrays(make(part), names)

    return docs.select(*read).mapInArrow(run, schema)


def count_terms(docs: DataFrame, columns: list[str], bits: int = DIGEST_BITS, with_text: bool = False) -> DataFrame:
    """(lang, source, digest, docs, n), a word of a group as often as slices hold it.

    with_text: also the word's text, as term. columns: those of text, language and source.
    """
    schema = "lang string, source string, digest long, docs long, n long" + ", term string" * with_text

    def make(part: pa.RecordBatch) -> list[pa.Array]:
        terms = Terms(part.column(0))
        names: dict[tuple[str, str], int] = {}
        pairs = zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)
        group = np.array([names.setdefault(pair, len(names)) for pair in pairs], np.int64)
        of_group, place, n_docs, n = terms.counts(group)
        made = [pa.array([pair[c] for pair in names], pa.string()).take(pa.array(of_group)) for c in (0, 1)]
        made += [pa.array(x.astype(np.int64)) for x in (terms.digests(bits)[place], n_docs, n)]
        if with_text:
            made.append(terms.texts.cast(pa.large_string()).cast(pa.string()).take(pa.array(place)))
        return made

    return _from_texts(docs, columns, schema, make)


def texts_of_digests(docs: DataFrame, columns: list[str], bits: int = DIGEST_BITS) -> DataFrame:
    """(digest, term, last): the smallest and the greatest text of each digest."""

    def make(part: pa.RecordBatch) -> list[pa.Array]:
        terms = Terms(part.column(0))
        used = np.unique(terms.place)
        texts = terms.texts.cast(pa.large_string()).cast(pa.string()).take(pa.array(used))
        return [pa.array(terms.digests(bits)[used]), texts]

    found = _from_texts(docs, columns[:1], "digest long, term string", make)
    # Slices have given each text once, so what is left is a digest's rows from all slices.
    each = found.repartition("digest").distinct()
    return each.groupBy("digest").agg(F.min("term").alias("term"), F.max("term").alias("last"))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE (count + 1) / (total + kept)); decimals hold any product."""
    product = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", product, (total + kept).cast("decimal(20,0)"))


def _distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most SCALE + 1, so a long holds the square."""
    return F.call_function("div", (p - q) * (p - q), q)


def _words(counted: DataFrame, least_docs: int) -> DataFrame:
    """(lang, digest, part, n_lang, sources) of the words that enough documents of a language hold.

    sources has the source and count of each that holds the word. Rows meet by language and
    digest once, tasks' counts of a word at a time.
    """
    keys = ["lang", "digest", "part"]
    counts = counted.repartition(*keys).groupBy(*keys, "source").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    words = counts.groupBy(*keys).agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n_lang"), F.collect_list(F.struct("source", "n")).alias("sources")
    )
    return words.where(F.col("docs") >= least_docs).drop("docs")


def _pairs(words: DataFrame, grouped: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): each source against each other one of its language.

    A word that a source hasn't got has the source's smallest share there. So the sum over
    all kept words is that of two sources without words, plus what each one's words change,
    by the few distinct counts, plus a correction for words that both have.
    """
    one = groups.select("lang", "source", "kept", F.col("least").alias("p0"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("least").alias("q0"))
    both = one.join(other, "lang").where("source <> item")
    none = _distance(F.col("p0"), F.col("q0"))
    wide = lambda value: value.cast("decimal(20,0)")
    start = both.select("lang", "source", "item", (wide(F.col("kept")) * wide(none)).alias("value"))

    shares = written(grouped.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("words")))
    own = both.join(shares, ["lang", "source"])
    own = own.select("lang", "source", "item", (wide(F.col("words")) * wide(_distance(F.col("p"), F.col("q0")) - none)).alias("value"))
    theirs = both.join(shares.select("lang", F.col("source").alias("item"), F.col("p").alias("q"), "words"), ["lang", "item"])
    theirs = theirs.select(
        "lang", "source", "item", (wide(F.col("words")) * wide(_distance(F.col("p0"), F.col("q")) - none)).alias("value")
    )

    # The sources of a word meet in its row, each two of them once, for both directions. Words
    # with the same two counts change a pair alike, so shares are computed once for all of them.
    met = words.select("lang", F.explode("sources").alias("a"), "sources")
    met = met.select("lang", "a", F.explode("sources").alias("b")).where("a.source < b.source")
    met = met.select("lang", *(F.col(f"{x}.{c}").alias(f"{c}_{x}") for x in "ab" for c in ("source", "n")))
    met = met.groupBy(*met.columns).agg(F.count(F.lit(1)).alias("words"))
    for side in "ab":
        names = [F.col(c).alias(f"{c}_{side}") for c in ("source", "total", "least")]
        met = met.join(groups.select("lang", *names, *([F.col("kept")] if side == "a" else [])), ["lang", f"source_{side}"])
    p, q = (_share(F.col(f"n_{x}"), F.col(f"total_{x}"), F.col("kept")) for x in "ab")
    met = met.select("lang", "source_a", "source_b", "words", p.alias("p"), q.alias("q"), F.col("least_a").alias("p0"), F.col("least_b").alias("q0"))
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    change = lambda p, q, p0, q0: _distance(p, q) - _distance(p, q0) - _distance(p0, q) + _distance(p0, q0)
    met = met.groupBy("lang", "source_a", "source_b").agg(
        *(F.sum(wide(F.col("words")) * wide(c)).alias(n) for c, n in ((change(p, q, p0, q0), "there"), (change(q, p, q0, p0), "back")))
    )
    met = met.select("lang", F.inline(F.array(*(
        F.struct(F.col(f"source_{x}").alias("source"), F.col(f"source_{y}").alias("item"), F.col(v).alias("value"))
        for x, y, v in (("a", "b", "there"), ("b", "a", "back"))
    ))))

    parts = [df.withColumn("value", F.col("value").cast("decimal(38,0)")) for df in (start, own, theirs, met)]
    return reduce(DataFrame.unionByName, parts).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))


def _terms(grouped: DataFrame, names: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank): the words that a source has more of than its language.

    The value of rank `top` is found among distinct values first, so that texts are fetched
    for no more words than can be reported, ties at the last value included.
    """
    more = written(
        grouped.where("p > q").select("lang", "source", "digest", "part", _distance(F.col("p"), F.col("q")).alias("value"))
    )
    of_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = more.groupBy("lang", "source", "value").agg(F.count(F.lit(1)).alias("words"))
    values = values.withColumn("place", F.row_number().over(of_group)).where(F.col("place") <= top)
    before = F.sum("words").over(of_group.rowsBetween(Window.unboundedPreceding, -1))
    least = values.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < top)
    least = least.groupBy("lang", "source").agg(F.min("value").alias("least"))
    near = more.join(least, ["lang", "source"]).where(F.col("value") >= F.col("least"))
    named = near.join(names, ["digest", "part"]).select("lang", "source", F.col("term").alias("item"), "value")
    return _ranked(named).where(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit_sources(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = LEAST_DOCS,
    top: int = TOP,
    digest_bits: int = DIGEST_BITS,
) -> DataFrame:
    """(lang, source, part, item, value, rank) for each occurring pair of language and source.

    A language keeps the words that at least least_docs of its documents hold. With a word's
    count in a group, the group's count N of all kept words and their number V, the share is
    1 + floor(10^9 (count + 1) / (N + V)), and p differs from q by floor((p - q)^2 / q).
    Part `pair` has every other source of the language, with the differences of all kept
    words summed. Part `term` has the words that the source holds and whose share is above
    the language's, the `top` first. Ranks are by value, then item in byte order.

    Nulls in any column count as empty text; each row is a document, repeated ones too. A
    group without words has pairs but no words; a language with one source has no pairs; an
    empty table gives no rows. Texts of any length are counted whole; a task holds the words
    of HELD_BYTES of text, or of one longer text. Other columns, whatever their names, aren't read. Sources meet pairwise
    in a language, as the result has a row for each pair.
    """
    columns = [text_col, lang_col, source_col]
    ends = written(texts_of_digests(docs, columns, digest_bits))
    counted = count_terms(docs, columns, digest_bits).withColumn("part", F.lit(0))
    names = ends.where("term = last").select("digest", F.lit(0).alias("part"), "term")
    shared = ends.where("term <> last").select("digest")
    if not shared.isEmpty():
        several = count_terms(docs, columns, digest_bits, with_text=True).join(shared, "digest", "left_semi")
        number = F.row_number().over(Window.partitionBy("digest").orderBy("term"))
        split = written(several.select("digest", "term").distinct().withColumn("part", number))
        apart = several.join(split, ["digest", "term"]).drop("term")
        counted = counted.join(shared, "digest", "left_anti").unionByName(apart)
        names = names.unionByName(split.select("digest", "part", "term"))
    words = written(_words(counted, least_docs))

    one_each = words.select("lang", "digest", "part", "n_lang", F.inline("sources"))
    of_lang = words.groupBy("lang").agg(F.sum("n_lang").alias("total_lang"), F.count(F.lit(1)).alias("kept"))
    of_group = one_each.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in zip(columns[1:], ("lang", "source"))]
    groups = docs.select(*named).distinct().join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
    zero = F.lit(0).cast("long")
    groups = groups.select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("total", "total_lang", "kept")))
    # Without kept words there are no shares, and their differences count no times.
    kept = F.when(F.col("kept") > 0, F.col("kept"))
    least = F.coalesce(_share(zero, F.col("total"), kept), F.lit(1).cast("long"))
    groups = written(groups.withColumn("least", least))

    of_word = one_each.join(groups, ["lang", "source"])
    p, q = _share(F.col("n"), F.col("total"), F.col("kept")), _share(F.col("n_lang"), F.col("total_lang"), F.col("kept"))
    grouped = of_word.select("lang", "source", "digest", "part", p.alias("p"), q.alias("q"))
    pairs = _ranked(_pairs(words, grouped, groups)).withColumn("kind", F.lit("pair"))
    terms = _terms(grouped, names, top).withColumn("kind", F.lit("term"))
    columns = ["lang", "source", F.col("kind").alias("part"), "item", "value", "rank"]
    return pairs.select(*columns).unionByName(terms.select(*columns))
