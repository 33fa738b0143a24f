"""Source divergence audit: how far the sources of a language differ in their words, and in which.

Tokenizer. One ``bytes.translate`` over a text's UTF-8 bytes lowers A-Z and blanks every other ASCII byte
that is no letter; ``bytes.split`` gives the terms and one Counter per document their frequencies. Bytes
from 0x80 on belong to terms, so a term is a run of letters and non-ASCII characters.

Counting is sparse: a task adds its documents' counters up by (language, source) and sends on what it
holds whenever that has grown to ``HELD`` entries, so a hot source or word is one row per task before
anything is shuffled.

Each language keeps the V terms that occur in ``min_docs`` of its documents or more. A count c of N
becomes p = 1 + floor(10^9 (c + 2) / (N + 2 V)), and two such numbers differ by
f = floor((p - q)^2 / (p + q)). All of it is whole-number arithmetic.

Sums over all kept terms need the terms that a source lacks, too. Terms are dealt into blocks by their
hash; a block's counts are laid out as a small matrix of terms by sources, where a missing count has the
p of zero, and all pairs of sources are summed there. So no row is made per term and pair.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, quoted, ship, slices, stage, text_bytes

#: A-Z to a-z, other ASCII bytes outside a-z to a blank; bytes from 0x80 on stay.
LETTERS = bytes(
    c if c >= 0x80 or 0x61 <= c <= 0x7A else (c + 32 if 0x41 <= c <= 0x5A else 0x20) for c in range(256)
)
#: Terms held by a task before they are sent on.
HELD = 250_000
SCALE = 10**9
#: Cells of a block's matrix: at least, and at most (64 MB); between them, four rows of terms a source.
LEAST_CELLS, MOST_CELLS = 1 << 14, 1 << 23
#: Pairs of sources that one task sums at once.
PAIRS = 1 << 21

_COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def document_terms(text: bytes) -> Counter:
    """The terms of one text with their frequencies; a very long text is split part by part."""
    terms: Counter = Counter()
    for part in slices(text.translate(LETTERS)):
        terms.update(part.split())
    return terms


def _rows(lang: str, source: str, docs: Counter, more: Counter) -> Iterator[pa.RecordBatch]:
    """The group itself (as an empty term) and its terms."""
    terms = [b"", *docs]
    n = len(terms)
    seen = [0, *docs.values()]
    total = [a + more.get(t, 0) for t, a in zip(terms, seen)]
    columns = [pa.repeat(pa.scalar(lang), n), pa.repeat(pa.scalar(source), n), pa.array(terms, pa.binary()).view(pa.string())]
    yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(seen, pa.int64())], names=["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            group = groups.get((lang, source))
            if group is None:
                group = groups[lang, source] = (Counter(), Counter())
            docs, more = group
            terms = document_terms(text)
            held -= len(docs)
            docs.update(terms.keys())
            held += len(docs)
            for term, n in terms.items():
                if n > 1:
                    more[term] += n - 1
            if held > HELD:
                for key, counted in groups.items():
                    yield from _rows(*key, *counted)
                groups, held = {}, 0
    for key, counted in groups.items():
        yield from _rows(*key, *counted)


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term. Every occurring
    (lang, source) also has a row with an empty term and zeros. Nulls are read as empty texts."""
    named = lambda c: F.coalesce(quoted(c).cast("string"), F.lit(""))
    ready = docs.select(named(lang).alias("lang"), named(source).alias("source"), text_bytes(quoted(text)).alias("text"))
    parts = map_batches(ready, _count, _COUNTS)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, size: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 size)), exact for any long; 1 where there are no terms."""
    top = (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(size > 0, 1 + F.call_function("div", top, (total + 2 * size).cast("decimal(20,0)"))).otherwise(1).cast("bigint")


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums of f for one block of terms (left: term, source, p) and one slice of the pairs of sources
    (right: source, p of zero)."""
    lang, part, parts = right["lang"][0], right["part"][0].as_py(), right["parts"][0].as_py()
    order = sorted(zip(right["source"].to_pylist(), right["none"].to_pylist()))
    sources = [s for s, _ in order]
    place = {s: i for i, s in enumerate(sources)}
    codes = left["term"].combine_chunks().dictionary_encode().indices.to_numpy() if left.num_rows else np.zeros(0, np.int64)
    p = np.tile(np.array([none for _, none in order], np.int64), (int(codes.max()) + 1 if len(codes) else 0, 1))
    p[codes, [place[s] for s in left["source"].to_pylist()]] = left["p"].to_numpy() if left.num_rows else np.zeros(0, np.int64)
    a, b, values = [], [], []
    for i in range(part, len(sources) - 1, parts):
        mine, others = p[:, i : i + 1], p[:, i + 1 :]
        apart = mine - others
        values.append((apart * apart // (mine + others)).sum(axis=0, dtype=np.int64))
        a += [sources[i]] * (len(sources) - 1 - i)
        b += sources[i + 1 :]
    made = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.table({"lang": pa.repeat(lang, len(a)), "a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "value": made})


def source_pairs(held: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): for each two sources of a language, f summed over its kept terms."""
    cells = F.least(F.lit(MOST_CELLS), F.greatest(F.lit(LEAST_CELLS), 4 * F.col("sources") * F.col("sources")))
    laid = groups.withColumns(
        {
            "none": share(F.lit(0), F.col("total"), F.col("size")),
            "blocks": F.greatest(F.lit(1), F.ceil(F.col("size") * F.col("sources") / cells)).cast("int"),
            "parts": F.greatest(F.lit(1), F.ceil(F.col("sources") * F.col("sources") / F.lit(PAIRS))).cast("int"),
        }
    )
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    counted = held.join(laid, ["lang", "source"]).select(
        "lang",
        F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"),
        numbers("parts").alias("part"),
        "term",
        "source",
        share(F.col("n"), F.col("total"), F.col("size")).alias("p"),
    )
    around = laid.select("lang", "source", "none", "parts", "blocks", numbers("parts").alias("part")).select(
        "lang", numbers("blocks").alias("block"), "part", "parts", "source", "none"
    )
    ship(held.sparkSession)
    keys = ["lang", "block", "part"]
    summed = counted.groupBy(*keys).cogroup(around.groupBy(*keys)).applyInArrow(_pairs, "lang string, a string, b string, value bigint")
    pairs = summed.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return pairs.select("lang", F.inline(both), "value")


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank). Part ``pair``: the other sources of the language by their
    divergence from this one, all of them. Part ``term``: the ``top`` terms by which this source stands
    out from its language (p above the language's).

    Null texts, languages and sources are read as empty ones; a source without terms takes part in pairs
    as one that lacks every term. Repeated rows count each time. Equal values rank by the item's UTF-8
    bytes. A language without kept terms has pairs of value 0. A very long text is split part by part.
    An empty table gives an empty table. Other columns, of whatever names, are not read.
    """
    counts = stage(term_counts(docs, lang, source, text), "divergence-counts")
    terms = counts.where("term != ''")
    kept = stage(
        terms.groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("lang_docs"))
        .where(F.col("lang_docs") >= min_docs)
        .select("lang", "term", "lang_n"),
        "divergence-kept",
    )
    held = stage(terms.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "divergence-held")
    occurring = counts.where("term = ''").select("lang", "source")
    sources = occurring.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.sum("lang_n").alias("lang_total"))
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    groups = stage(
        occurring.join(sources, "lang").join(sizes, "lang", "left").join(totals, ["lang", "source"], "left")
        .select("lang", "source", "sources", zero("size"), zero("lang_total"), zero("total")),
        "divergence-groups",
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = source_pairs(held, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    p = share(F.col("n"), F.col("total"), F.col("size"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("size"))
    marked = held.where("n > 0").join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    marked = marked.where("p > q").select("lang", "source", "item", distance(F.col("p"), F.col("q")).alias("value"))
    best = marked.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return pairs.unionByName(best.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
