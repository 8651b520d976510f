"""How far the sources of a language are apart, by run-length encoded columns of term counts.

Every language keeps its common terms. Sorted so that terms with equal counts in all sources
stand together, a source's column of counts is a short list of runs. Two sources are compared
run by run: where neither of their runs ends, all terms add the same, so the divergence of a
term is computed once and multiplied by their number.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import map_batches, written
from shelfwise.session import checked_broadcast

#: A language keeps the terms that so many of its documents have.
MIN_DOCUMENTS = 10
TOP_TERMS = 10
#: Shares are whole parts of this; every count has two added to it.
PARTS = 1_000_000_000
ADDED = 2
#: Counts that a block of the vocabulary has about; a task holds the columns of one.
BLOCK_CELLS = 500_000
#: Different terms that a task counts before it hands them on.
TERMS_HELD = 500_000


def _byte_table() -> bytes:
    """Bytes of terms as they are, capitals as small letters, all others a space."""
    table = bytearray(b" " * 256)
    for c in (*range(0x61, 0x7B), *range(0x80, 0x100)):
        table[c] = c
    for c in range(0x41, 0x5B):
        table[c] = c + 0x20
    return bytes(table)


TERM_BYTES = _byte_table()


def _named(docs: DataFrame) -> DataFrame:
    """``lang``, ``source`` and ``text`` with nulls as empty strings."""
    return docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")),
        "text",
    )


def term_counts(docs: DataFrame) -> DataFrame:
    """(``lang``, ``source``, ``term``, ``n``, ``docs``): partial sums that the tasks made.

    Terms are runs of ASCII letters and of characters beyond ASCII, capital ASCII letters as
    small ones. ``n`` counts occurrences, ``docs`` documents.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def rows() -> pa.RecordBatch:
            sizes = [len(times) for times, _ in held.values()]
            each = np.repeat(np.arange(len(sizes)), sizes)
            langs, sources = (
                pa.array([group[i] for group in held], pa.string()).take(pa.array(each)) for i in (0, 1)
            )
            terms = [t for times, _ in held.values() for t in times]
            n = [x for times, _ in held.values() for x in times.values()]
            docs_with = [with_[t] for times, with_ in held.values() for t in times]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [
                    langs,
                    sources,
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array(n, pa.int64()),
                    pa.array(docs_with, pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )

        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            langs, sources = (batch.column(c).to_pylist() for c in ("lang", "source"))
            for i, group in enumerate(zip(langs, sources, strict=True)):
                terms = (texts[i].as_py() or b"").translate(TERM_BYTES).split()
                times, docs_with = held.setdefault(group, (Counter(), Counter()))
                times.update(terms)
                docs_with.update(set(terms))
            if sum(len(times) for times, _ in held.values()) > TERMS_HELD:
                yield rows()
        yield rows()

    return map_batches(_named(docs), count, "lang string, source string, term string, n long, docs long")


def kept_cells(counts: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """A written table of the counts above zero of kept terms, one row per term and source.

    ``lang``, ``source``, ``term``, ``n``, ``lang_n`` (the language's count), ``first`` (1 in one row of a term)
    and ``sign``, which is the same for terms with the same count in every source. All from one
    shuffle by (lang, term); a term has a row per source at most.
    """
    whole = Window.partitionBy("lang", "term")
    cells = (
        counts.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .withColumn("_docs", F.sum("docs").over(whole))
        .where(F.col("_docs") >= min_documents)
        .withColumn("lang_n", F.sum("n").over(whole))
        .withColumn("sign", F.bit_xor(F.xxhash64("source", "n")).over(whole))
        .withColumn("first", F.row_number().over(whole.orderBy("source")) == 1)
    )
    return written(
        cells.select("lang", "source", "term", "n", "lang_n", "sign", F.col("first").cast("long").alias("first")),
        "cells",
    )


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(PARTS * (n + ADDED) / (total + ADDED * terms)), exactly; null without terms."""
    above = (n.cast("decimal(20,0)") + ADDED) * F.lit(PARTS).cast("decimal(10,0)")
    below = total.cast("decimal(20,0)") + terms.cast("decimal(20,0)") * ADDED
    below = F.greatest(below, F.lit(1).cast("decimal(10,0)"))
    # The remainder goes first, so that the division has none and does not round.
    exact = ((above - above % below) / below).cast("long")
    return F.when(terms > 0, exact + 1)


def group_totals(docs: DataFrame, cells: DataFrame) -> DataFrame:
    """A written table: one row per (lang, source) that occurs, also without kept terms.

    ``total`` is its count of kept terms, ``terms`` the number of kept terms of the language,
    ``lang_total`` the language's count, ``zero`` the share of a term that it does not have.
    """
    found = _named(docs).select("lang", "source").distinct()
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("first").alias("_terms"))
    langs = sums.groupBy("lang").agg(
        F.sum("_terms").alias("terms"), F.sum("total").alias("lang_total")
    )
    groups = (
        found.join(sums.drop("_terms"), ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang",
            "source",
            *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "terms", "lang_total")),
        )
    )
    zero = share(F.lit(0), F.col("total"), F.col("terms"))
    return written(groups.withColumn("zero", zero), "groups")


def runs_of(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run-length code of a column: where each run ends, and its value."""
    ends = np.append(np.flatnonzero(np.diff(column)) + 1, len(column))
    return ends, column[ends - 1]


def run_divergence(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Sum over all terms of two run-length coded columns, one division per common run."""
    ends = np.union1d(a[0], b[0])
    p, q = (values[np.searchsorted(own, ends)] for own, values in (a, b))
    lengths = np.diff(ends, prepend=0)
    return int(((p - q) * (p - q) // (p + q) * lengths).sum())


def pair_sums(cells: DataFrame, groups: DataFrame, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """(``lang``, ``source``, ``item``, ``value``) for both orders of every two sources of a language with terms.

    Terms are sorted into ranges by (language, language's count, sign, term): equal columns stand
    together. A range of one language is a block; a task makes the columns of one block,
    run-length codes them and sums over common runs, and the sums of the blocks are added.
    Blocks grow in number with the counts, not in size.
    """
    blocks = max(1, -(-cells.count() // block_cells))
    order = ["lang", "lang_n", "sign", "term"]
    sizes = checked_broadcast(groups.select("lang", "source", "total", "terms"))
    shares = cells.join(sizes, ["lang", "source"]).select(
        *order, "source", share(F.col("n"), F.col("total"), F.col("terms")).alias("p")
    )
    ranged = shares.repartitionByRange(blocks, *order).withColumn("block", F.spark_partition_id())
    ranged = written(ranged, "columns")
    # Every block of a language has a column of each of its sources, if only of zero counts.
    places = ranged.select(F.col("lang").alias("_lang"), F.col("block").alias("_block")).distinct()
    heads = groups.join(places, F.col("lang") == F.col("_lang"))

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        cols = {"lang": [], "source": [], "item": [], "value": []}
        if left.num_rows and right.num_rows:
            lang = right["_lang"][0].as_py()
            keys = left.select(["lang_n", "sign", "term"])
            keys = keys.append_column("row", pa.array(np.arange(left.num_rows)))
            keys = keys.sort_by([(c, "ascending") for c in ("lang_n", "sign", "term")])
            terms = keys["term"].combine_chunks()
            new = np.ones(len(terms), dtype=bool)
            new[1:] = pc.not_equal(terms[1:], terms[:-1]).to_numpy(zero_copy_only=False)
            place = np.empty(len(terms), dtype=np.int64)
            place[keys["row"].to_numpy()] = np.cumsum(new) - 1
            shares = left["p"].to_numpy()
            codes = left["source"].combine_chunks().dictionary_encode()
            own = codes.indices.to_numpy()
            rows_of = {
                s: np.flatnonzero(own == i) for i, s in enumerate(codes.dictionary.to_pylist())
            }
            coded = []
            for source, zero in zip(right["source"].to_pylist(), right["zero"].to_pylist(), strict=True):
                column = np.full(int(new.sum()), zero, dtype=np.int64)
                if source in rows_of:
                    column[place[rows_of[source]]] = shares[rows_of[source]]
                coded.append((source, runs_of(column)))
            for i, (a, runs_a) in enumerate(coded):
                for b, runs_b in coded[i + 1 :]:
                    value = run_divergence(runs_a, runs_b)
                    cols["lang"] += [lang, lang]
                    cols["source"] += [a, b]
                    cols["item"] += [b, a]
                    cols["value"] += [value, value]
        text, number = pa.string(), pa.int64()
        return pa.table(cols, schema=pa.schema([("lang", text), ("source", text), ("item", text), ("value", number)]))

    parts = (
        ranged.groupBy("lang", "block")
        .cogroup(heads.select("_lang", "_block", "source", "zero").groupBy("_lang", "_block"))
        .applyInArrow(sums, "lang string, source string, item string, value long")
    )
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def top_terms(cells: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """The terms of a source that are over-represented in it, by divergence, the first ``top`` of each."""
    p = share(F.col("n"), F.col("total"), F.col("terms"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    rows = (
        cells.join(checked_broadcast(groups), ["lang", "source"])
        .withColumn("_p", p)
        .withColumn("_q", q)
        .where("_p > _q")
        .select("lang", "source", F.col("term").alias("item"), F.expr("(_p - _q) * (_p - _q) div (_p + _q)").alias("value"))
    )
    return _ranked(rows).where(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """Divergence of every two sources of a language, and the terms that mark a source.

    ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``. A language keeps the terms that at least
    ``min_documents`` of its documents have. A source's share of a term is ``share`` of its count.
    Part ``pair``: every other source, with the sum of ``(p - q)**2 // (p + q)`` over all kept terms (0 if
    none is kept). Part ``term``: up to ``top`` terms with a greater share in the source than in the
    language, with that term's part of the sum. Ranks go by value, then by item.

    Null texts, languages and sources are empty ones; empty texts and texts without terms
    still name their source; repeated rows count each. A single source has no pairs; an
    empty table gives no rows. Other columns are not read, whatever their names.
    """
    cells = kept_cells(term_counts(docs), min_documents)
    groups = group_totals(docs, cells)
    one = groups.select("lang", "source")
    other = groups.select("lang", F.col("source").alias("item"))
    pairs = (
        one.join(other, "lang")
        .where("source != item")
        .join(pair_sums(cells, groups), ["lang", "source", "item"], "left")
        .select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        _ranked(pairs)
        .withColumn("part", F.lit("pair"))
        .select(*columns)
        .union(top_terms(cells, groups, top).withColumn("part", F.lit("term")).select(*columns))
    )


def oracle_sql() -> str:
    f = "((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)"
    p = f"1 + ({PARTS}::hugeint * (%s + {ADDED})) // (%s.total + {ADDED} * v)"
    return f"""with d as (
  select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
  from documents
),
t as materialized (select lang, source, rid, unnest(terms) as term from d),
kept as materialized (
  select lang, term, count(*) as lang_n from t
  group by all having count(distinct rid) >= {MIN_DOCUMENTS}
),
langs as materialized (
  select lang, count(*) as v, sum(lang_n) as total from kept group by lang
),
groups as materialized (select distinct lang, source from d),
counts as materialized (
  select g.lang, g.source, k.term, count(t.rid) as n
  from groups g join kept k on k.lang = g.lang
       left join t on t.lang = g.lang and t.source = g.source and t.term = k.term
  group by all
),
totals as materialized (select lang, source, sum(n) as total from counts group by all),
shares as materialized (
  select c.lang, c.source, c.term, c.n, {p % ("c.n", "g")} as p
  from counts c join totals g on g.lang = c.lang and g.source = c.source
       join langs l on l.lang = c.lang
),
lang_shares as materialized (
  select k.lang, k.term, {p % ("k.lang_n", "l")} as p
  from kept k join langs l on l.lang = k.lang
),
pair_sums as (
  select a.lang, a.source, b.source as item, sum({f}) as value
  from shares a join shares b on b.lang = a.lang and b.term = a.term and b.source != a.source
  group by all
),
pairs as (
  select g.lang, g.source, 'pair' as part, h.source as item, coalesce(s.value, 0) as value
  from groups g join groups h on h.lang = g.lang and h.source != g.source
       left join pair_sums s on s.lang = g.lang and s.source = g.source and s.item = h.source
),
terms as (
  select a.lang, a.source, 'term' as part, a.term as item, {f} as value
  from shares a join lang_shares b on b.lang = a.lang and b.term = a.term
  where a.n > 0 and a.p > b.p
),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from pairs union all select * from terms)
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from ranked where part = 'pair' or rank <= {TOP_TERMS}"""
