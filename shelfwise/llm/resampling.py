"""Importance resampling towards a target: documents drawn by the likeness of their words.

Features are runs of words, hashed into buckets by CRC-32. A dictionary of the words of a
batch of texts is an Aho-Corasick automaton: every word stands in it between two delimiters
and carries its number, which leads to its CRC and its length. One scan of a text emits the
words' payloads in order; those of neighbours are composed to the CRC of a run, so no run is
ever put together as a string.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from math import floor, log

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import buckets_of, map_batches, squeezed, unsqueezed, written

#: Longest run of words that is a feature, buckets, least words of a drawn document.
MAX_RUN = 1
BUCKETS = 10_000
MIN_WORDS = 20
#: Share of the documents with enough words that is drawn, in hundredths.
PERCENT = 10
SEED = "2024"
#: Bytes of texts whose words make one dictionary, but for one longer text.
DICTIONARY_BYTES = 4_000_000
_POLYNOMIAL = 0xEDB88320


def _byte_table() -> bytes:
    """Bytes of words as they are, capitals as small letters, all others a space."""
    table = bytearray(b" " * 256)
    for c in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
        table[c] = c
    for c in range(0x41, 0x5B):
        table[c] = c + 0x20
    return bytes(table)


WORD_BYTES = _byte_table()


@lru_cache(maxsize=4096)
def _zeros(length: int) -> np.ndarray:
    """Four tables of 256: what ``length`` zero bytes make of each byte of a CRC register."""
    columns = np.array([1 << i for i in range(32)], dtype=np.uint64)
    step = columns.copy()
    for _ in range(8):
        step = np.where(step & np.uint64(1), (step >> np.uint64(1)) ^ np.uint64(_POLYNOMIAL), step >> np.uint64(1))

    def apply(matrix: np.ndarray, values: np.ndarray) -> np.ndarray:
        bits = (values[:, None] >> np.arange(32, dtype=np.uint64)) & np.uint64(1)
        return np.bitwise_xor.reduce(np.where(bits == 1, matrix[None, :], np.uint64(0)), axis=1)

    power, left = step, length
    while left:
        if left & 1:
            columns = apply(power, columns)
        power, left = apply(power, power), left >> 1
    each = np.arange(256, dtype=np.uint64)
    return np.stack([apply(columns, each << np.uint64(8 * b)) for b in range(4)]).astype(np.uint32)


def composed(left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs of the strings of ``left`` followed by those of ``right``, which have ``lengths`` bytes."""
    out = np.empty_like(left)
    for length in np.unique(lengths).tolist():
        at = lengths == length
        table, crc = _zeros(length), left[at]
        out[at] = right[at]
        for b in range(4):
            out[at] ^= table[b][(crc >> np.uint32(8 * b)) & np.uint32(255)]
    return out


class Dictionary:
    """The different words of some texts: an automaton of delimited words and their payloads."""

    def __init__(self, texts: Sequence[str]) -> None:
        words = sorted(set().union(*(t.split(" ") for t in texts)) - {""})
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, word in enumerate(words):
            self.automaton.add_word(f" {word} ", number)
        if words:
            self.automaton.make_automaton()
        bodies = [w.encode() for w in words]
        self.crc = np.array([zlib.crc32(b) for b in bodies], dtype=np.uint32)
        #: The same with the space that joins a word to the one before it.
        self.joined = np.array([zlib.crc32(b" " + b) for b in bodies], dtype=np.uint32)
        self.length = np.array([len(b) + 1 for b in bodies], dtype=np.int64)

    def payloads(self, text: str) -> np.ndarray:
        """Numbers of a text's words in order. A text begins and ends with the delimiter."""
        if not len(self.crc):
            return np.empty(0, dtype=np.int64)
        return np.fromiter((number for _, number in self.automaton.iter(text)), dtype=np.int64)

    def features(self, text: str, max_run: int) -> tuple[int, np.ndarray]:
        """Number of words, and the CRCs of all runs of one to ``max_run`` words."""
        numbers = self.payloads(text)
        runs = [crc := self.crc[numbers]]
        for size in range(2, max_run + 1):
            last = numbers[size - 1 :]
            if not len(last):
                break
            crc = composed(crc[: len(last)], self.joined[last], self.length[last])
            runs.append(crc)
        return len(numbers), np.concatenate(runs)


def _groups(bodies: list[bytes]) -> Iterator[list[bytes]]:
    """Texts in a row, together up to ``DICTIONARY_BYTES`` or one alone."""
    some: list[bytes] = []
    size = 0
    for body in bodies:
        if some and size + len(body) > DICTIONARY_BYTES:
            yield some
            some, size = [], 0
        some.append(body)
        size += len(body)
    if some:
        yield some


def hashed_features(texts: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS) -> DataFrame:
    """``texts`` with ``text`` replaced by ``n_words``, ``n_features`` and ``buckets``.

    ``buckets`` holds the bucket of every feature as compressed 32-bit numbers, so that a text is
    read and scanned once for both counting and scoring. A null text has no words.
    """
    others = [c for c in texts.columns if c != "text"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text").cast(pa.large_binary()).to_pylist()
            words, counts, packed = [], [], []
            for group in _groups([b or b"" for b in column]):
                # Delimiters next to each other become one, so neighbours share theirs.
                plain = [b" ".join([b"", *b.translate(WORD_BYTES).split(), b""]) for b in group]
                plain = [p.decode(errors="replace") for p in plain]
                dictionary = Dictionary(plain)
                for text in plain:
                    n, crcs = dictionary.features(text, max_run)
                    words.append(n)
                    counts.append(len(crcs))
                    packed.append(squeezed(crcs % np.uint32(buckets)) if len(crcs) else b"")
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in others),
                    pa.array(words, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(packed, pa.binary()),
                ],
                [*others, "n_words", "n_features", "buckets"],
            )

    kinds = [f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in others]
    return map_batches(texts, scan, ", ".join([*kinds, "n_words long", "n_features long", "buckets binary"]))


def _unpacked(body: bytes | None) -> np.ndarray:
    return unsqueezed(body, np.uint32) if body else np.empty(0, dtype=np.uint32)


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of the whole table fall into each bucket.

    Tasks count their own rows first. What is shuffled is at most ``buckets`` rows a task, what
    comes to the driver ``buckets`` rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for body in batch.column("buckets").to_pylist():
                total += np.bincount(_unpacked(body), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    rows = map_batches(features.select("buckets"), count, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of each bucket's smoothed share in ``target`` over that in ``raw``."""
    buckets = len(raw)
    t_all, s_all = float(target.sum() + buckets), float(raw.sum() + buckets)
    return np.array(
        [
            floor(1000 * log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
            for t, s in zip(target.tolist(), raw.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def weighted(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """``features`` with ``weight`` instead of ``buckets``: the floored mean of the gains, 0 without any."""
    others = [c for c in features.columns if c != "buckets"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = []
            for body in batch.column("buckets").to_pylist():
                own = gain[_unpacked(body)]
                weights.append(int(own.sum()) // len(own) if len(own) else 0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array(weights, pa.int64())], [*others, "weight"]
            )

    kinds = ", ".join(f"`{c}` {features.schema[c].dataType.simpleString()}" for c in others)
    return map_batches(features, weigh, f"{kinds}, weight long")


def noise(key: Column, seed: str = SEED) -> Column:
    """1000 times a Gumbel-distributed number that a hash of ``key`` gives, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def drawn(scored: DataFrame, n: int, key: str) -> DataFrame:
    """``scored`` with ``rank``: 1 for the highest ``score`` and so on to ``n``, null for the others.

    Rows with ``eligible`` take part; ties go to the smaller ``key`` (null first), then to the smaller ``rid``.
    The lowest score that is drawn comes from a count of rows per score. Scores are whole
    numbers in a range that the size of the counts bounds (about 10**5 of them), whatever the
    number of rows. Rows from it on are sorted into ranges of (score, key, rid) and numbered
    inside a range after the rows of those before, so one score or key with a third of all
    rows is spread over many tasks. ``scored`` is a written table.
    """
    histogram = scored.where("eligible").groupBy("score").agg(F.count("*").alias("n")).collect()
    left, least = n, None
    for row in sorted(histogram, key=lambda r: -r.score):
        if left <= 0:
            break
        least, left = row.score, left - row.n
    none = F.lit(None).cast("long")
    if least is None:
        return scored.withColumn("rank", none)
    high = F.col("eligible") & (F.col("score") >= least)
    order = [F.desc("score"), F.asc_nulls_first(key), F.asc("rid")]
    ranged = scored.where(high).repartitionByRange(buckets_of(scored.sparkSession), *order)
    ranged = written(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n")).collect()
    starts, total = {}, 0
    for row in sorted(sizes):
        starts[row["_range"]] = total
        total += row["_n"]
    start = F.element_at(
        F.create_map(*(F.lit(x) for pair in starts.items() for x in pair)), F.col("_range")
    )
    nth = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    rank = (start + nth).cast("long")
    ranked = ranged.withColumn("rank", F.when(rank <= n, rank)).drop("_range")
    return scored.where(~high).withColumn("rank", none).union(ranked)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    max_run: int = MAX_RUN,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: str = SEED,
) -> DataFrame:
    """Every row of ``docs`` with its weight, its score and its rank among those drawn.

    ``doc_id``, ``n_features``, ``weight``, ``score``, ``rank``. Words are runs of ASCII letters and
    digits and of all characters beyond ASCII, ASCII letters in lower case. A document's
    weight is the floored mean of its features' gains, which compare how often the texts of
    ``target`` and of ``docs`` have a bucket; with hash noise added, the highest scores are a
    sample by importance without replacement, the same in every run. Of the documents with
    ``min_words`` words ``percent`` hundredths are drawn, rounded down; ties go to the smaller id.

    A null or empty text has no features, weight 0 and no rank. A null id counts as an empty
    one for the noise and comes first among ties. Repeated rows are weighed and drawn row by
    row. An empty ``docs`` gives no rows; with an empty ``target`` rare buckets gain. Columns
    other than ``doc_id`` and ``text`` are not read, whatever their names.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    features = written(hashed_features(rows, max_run, buckets), "features")
    wanted = hashed_features(target.select("text"), max_run, buckets)
    gain = gains(bucket_counts(wanted, buckets), bucket_counts(features, buckets))
    scores = weighted(features, gain).withColumn(
        "score", F.col("weight") + noise(F.col("doc_id"), seed)
    )
    scored = written(scores.withColumn("eligible", F.col("n_words") >= min_words), "scores")
    n = scored.where("eligible").count() * percent // 100
    return drawn(scored, n, "doc_id").select("doc_id", "n_features", "weight", "score", "rank")


def oracle_sql() -> str:
    """CRCs are computed in SQL too, once per different word, by the usual table of 256."""
    gain = "floor(1000 * ln((t + 1.0::double) * (s_all + {0}) / ((s + 1.0::double) * (t_all + {0}))))".format(BUCKETS)
    words = """regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""
    return f"""with crc_table as materialized (
  select list(v order by i) as tbl from (
    select i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda a, x:
             case when a & 1 = 1 then xor(a >> 1, {_POLYNOMIAL}::bigint) else a >> 1 end) as v
    from (select unnest(range(0, 256)) as i))
),
d as materialized (
  select row_number() over () as rid, doc_id, {words.format("coalesce(text, '')")} as words from documents
),
w as materialized (select rid, unnest(words) as word from d),
b as materialized (
  select unnest({words.format("coalesce(text, '')")}) as word from benchmark
),
buckets as materialized (
  select word, xor(list_reduce(list_prepend(4294967295::bigint,
      list_transform(range(0, octet_length(encode(word))), lambda i:
          ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::bigint)),
      lambda a, c: xor(a >> 8, tbl[(xor(a, c) & 255) + 1])), 4294967295::bigint) % {BUCKETS} as bucket
  from (select word from w union select word from b), crc_table
),
raw as (select bucket, count(*) as s from w join buckets using (word) group by bucket),
target as (select bucket, count(*) as t from b join buckets using (word) group by bucket),
sums as (select (select count(*) from w) as s_all, (select count(*) from b) as t_all),
gains as materialized (
  select bucket, cast({gain} as bigint) as gain
  from (select bucket, coalesce(s, 0) as s, coalesce(t, 0) as t from raw full join target using (bucket)), sums
),
means as (
  select rid, count(*) as n, cast(sum(gain) as bigint) as total
  from w join buckets using (word) join gains using (bucket) group by rid
),
scored as (
  select d.rid, d.doc_id, coalesce(n, 0) as n_features,
         coalesce((total - ((total % n) + n) % n) // n, 0) as weight,
         cast(floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint::double
                                    + 0.5::double) / 4294967296.0::double))) as bigint) as noise
  from d left join means using (rid)
),
ranked as (
  select rid, row_number() over (order by weight + noise desc, doc_id nulls first) as rank
  from scored where n_features >= {MIN_WORDS}
),
size as (select {PERCENT} * count(*) // 100 as k from ranked)
select doc_id, cast(n_features as bigint) as n_features, cast(weight as bigint) as weight,
       cast(weight + noise as bigint) as score,
       cast(case when rank <= (select k from size) then rank end as bigint) as rank
from scored left join ranked using (rid)"""
