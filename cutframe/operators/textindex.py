"""A kept inverted index: postings on disk in blocks, partitioned by shelf of documents and bucket of terms, searched by BM25 with block bounds.

A block holds a term's postings for one span of document ids, with the greatest tf and the least length in it: the greatest weight that any of its
postings can have, whatever the corpus's mean length is by then. Spans are the same for all terms, so a query's bound for a span is the sum over
its words. A search reads these bounds for its own terms, scores the spans of greatest bound, and then only spans whose bound reaches the k-th score found so far.

Texts are dealt by span, and all else is worked out where a span's texts lie: postings, several times as large, are never shuffled. So a bucket's
partition has a file from each task.

Ids are the catalogue's, counted up from 0; where they are sparse, blocks get smaller, results stay the same. A change rewrites the shelves of the
documents it names and no others; applied twice, it changes nothing more. It takes postings out of blocks and puts those of changed texts into
blocks of their own, so a term may have several blocks in a span then. Documents without a word have no posting and don't count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.files import overwrite_partitions
from .search import WORD

#: Terms of all queries up to which they are pushed down to the files one by one; beyond, only their buckets are.
PUSHED_TERMS = 500
#: Shelves that a change rewrites at a time; a bit for each of their documents is sent to every task (8 MB).
SHELVES = 64
POSTS = "array<struct<doc_id:bigint,tf:bigint,n:bigint>>"


def _words(column: str) -> Column:
    return F.regexp_extract_all(F.lower(column), F.lit(WORD), F.lit(0))


@dataclass(frozen=True)
class TextIndex:
    """An index at a path; span divides shelf."""

    spark: SparkSession
    path: str
    buckets: int = 16
    span: int = 1024
    shelf: int = 1 << 20

    # -- tables ---------------------------------------------------------------------------------------------------

    def blocks(self) -> DataFrame:
        """shelf, bucket, term, span, posts, docs, most_tf, least_n. A partition's marker has an empty term and no posting."""
        return self.spark.read.schema(f"term string, span bigint, posts {POSTS}, docs bigint, most_tf bigint, least_n bigint, shelf bigint, bucket int").parquet(f"{self.path}/blocks")

    def lengths(self) -> DataFrame:
        return self.spark.read.schema("doc_id bigint, n bigint, shelf bigint").parquet(f"{self.path}/lengths").filter("doc_id is not null")

    def totals(self) -> DataFrame:
        return self.spark.read.schema("docs bigint, words bigint, shelf bigint").parquet(f"{self.path}/totals")

    def postings(self) -> DataFrame:
        """term, doc_id, tf."""
        return self.blocks().select("term", F.explode("posts").alias("p")).select("term", "p.doc_id", "p.tf")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("term"), F.lit(self.buckets)).cast("int")

    def _of(self, ids: str, size: int) -> Column:
        return F.floor(F.col(ids) / size)

    # -- upkeep ---------------------------------------------------------------------------------------------------

    def _blocks_of(self, docs: DataFrame) -> DataFrame:
        """The blocks of these texts: one shuffle, of the texts."""
        dealt = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("span", self._of("doc_id", self.span)).repartition("span")
        rows = dealt.select("span", "doc_id", _words("text").alias("w")).select("span", "doc_id", F.size("w").cast("bigint").alias("n"), F.explode("w").alias("term"))
        rows = rows.groupBy("span", "term", "doc_id").agg(F.count("*").alias("tf"), F.first("n").alias("n"))
        rows = rows.groupBy("span", "term").agg(F.sort_array(F.collect_list(F.struct("doc_id", "tf", "n"))).alias("posts"))
        return self._counted(rows)

    def _counted(self, rows: DataFrame) -> DataFrame:
        """Blocks with their bounds and places, from term, span, posts."""
        bounds = {"docs": F.size("posts").cast("bigint"), "most_tf": F.array_max("posts.tf"), "least_n": F.array_min("posts.n")}
        return rows.withColumns(bounds | {"shelf": self._of("span", self.shelf // self.span), "bucket": self._bucket()})

    def _write(self, blocks: DataFrame, shelves: DataFrame) -> None:
        """Replace these shelves; a marker in each partition clears those that are empty now."""
        marker = shelves.select("shelf", F.explode(F.sequence(F.lit(0), F.lit(self.buckets - 1))).alias("bucket")).select(
            F.lit("").alias("term"), F.lit(-1).cast("bigint").alias("span"), F.array().cast(POSTS).alias("posts"), *(F.lit(0).cast("bigint").alias(c) for c in ("docs", "most_tf", "least_n")), "shelf", "bucket"
        )
        rows = blocks.select(*marker.columns).unionAll(marker)
        overwrite_partitions(rows.sortWithinPartitions("shelf", "bucket", "term", "span"), f"{self.path}/blocks", "shelf", "bucket", compression="zstd")
        held = self.blocks().join(F.broadcast(shelves), "shelf", "left_semi").select("shelf", F.explode("posts").alias("p"))
        own = held.groupBy("shelf", F.col("p.doc_id").alias("doc_id")).agg(F.sum("p.tf").alias("n")).select("doc_id", "n", "shelf")
        none = shelves.select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("n"), "shelf")
        overwrite_partitions(own.unionAll(none).repartition("shelf"), f"{self.path}/lengths", "shelf")
        sums = self.spark.read.schema("doc_id bigint, n bigint, shelf bigint").parquet(f"{self.path}/lengths").join(shelves, "shelf", "left_semi")
        overwrite_partitions(sums.groupBy("shelf").agg(F.count("doc_id").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).select("docs", "words", "shelf"), f"{self.path}/totals", "shelf")

    def build(self, docs: DataFrame) -> TextIndex:
        """Index docs(doc_id, text) from nothing; rows without an id are left out, of an id that repeats all texts count as one."""
        docs = docs.filter("doc_id is not null")
        self._write(self._blocks_of(docs), docs.select(self._of("doc_id", self.shelf).alias("shelf")).distinct())
        return self

    def apply(self, gone: DataFrame, changed: DataFrame) -> TextIndex:
        """Take out documents that went (doc_id), and index changed ones (doc_id, text) anew."""
        changed = changed.filter("doc_id is not null")
        old = gone.select(F.col("doc_id").cast("bigint").alias("doc_id")).unionByName(changed.select(F.col("doc_id").cast("bigint").alias("doc_id"))).filter("doc_id is not null")
        shelf = self._of("doc_id", self.shelf)
        numbers = sorted(r.shelf for r in old.select(shelf.alias("shelf")).distinct().collect())  # shelves of documents that changed: few thousand in the largest catalogue
        for at in range(0, len(numbers), SHELVES):
            some = numbers[at : at + SHELVES]
            held = self.blocks().filter(F.col("shelf").isin(some) & (F.col("term") != "")).drop("shelf", "bucket")
            left = self._without(held, old.filter(shelf.isin(some)))
            new = self._blocks_of(changed.filter(shelf.isin(some)))
            self._write(left.unionByName(new), self.spark.createDataFrame([(x,) for x in some], "shelf bigint"))
        return self

    def _without(self, blocks: DataFrame, old: DataFrame) -> DataFrame:
        """The blocks without these documents: a bit for each of a span's documents goes to the blocks, which stay where they are."""
        place = F.col("doc_id") - F.col("span") * self.span
        bits = old.withColumn("span", self._of("doc_id", self.span)).withColumn("word", F.floor(place / 64))
        bits = bits.groupBy("span", "word").agg(F.bit_or(F.expr(f"shiftleft(1L, cast((doc_id - span * {self.span}) % 64 as int))")).alias("bits"))
        marks = bits.groupBy("span").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("marks"))

        def stays(p: Column) -> Column:
            place = p["doc_id"] - F.col("span") * self.span
            return F.getbit(F.coalesce(F.element_at("marks", F.floor(place / 64)), F.lit(0).cast("bigint")), (place % 64).cast("int")) == 0

        rows = blocks.join(F.broadcast(marks), "span", "left")
        rows = rows.select("term", "span", F.when(F.col("marks").isNull(), F.col("posts")).otherwise(F.filter("posts", stays)).alias("posts"))
        return self._counted(rows.filter(F.size("posts") > 0))

    # -- search ---------------------------------------------------------------------------------------------------

    def _asked(self, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(query_id, term, need) and the blocks of these terms: only their partitions are read."""
        words = queries.select("query_id", F.explode(F.array_distinct(_words("query"))).alias("term"))
        words = words.withColumn("need", F.count("*").over(Window.partitionBy("query_id")))
        terms = words.select("term").distinct().withColumn("bucket", self._bucket())
        blocks = self.blocks().filter(F.col("bucket").isin([r.bucket for r in terms.select("bucket").distinct().collect()]))  # at most `buckets`
        few = terms.select("term").limit(PUSHED_TERMS + 1).collect()
        return words, blocks.filter(F.col("term").isin([r.term for r in few])) if len(few) <= PUSHED_TERMS else blocks.join(terms.select("term"), "term", "left_semi")

    def plan(self, queries: DataFrame, k: int, k1: float = 1.2, b: float = 0.75, probe: int = 4) -> tuple[DataFrame, DataFrame]:
        """(spans, hits): query_id, span, bound, opened of every span that holds all words of a query; query_id, doc_id, score of the opened ones."""
        words, blocks = self._asked(queries)
        corpus = self.totals().agg(F.sum("docs").alias("corpus"), (F.sum("words") / F.sum("docs")).alias("mean"))
        heads = words.join(blocks.select("term", "span", "docs", "most_tf", "least_n"), "term")
        heads = heads.groupBy("query_id", "term", "need", "span").agg(F.sum("docs").alias("docs"), F.max("most_tf").alias("most_tf"), F.min("least_n").alias("least_n"))
        df = heads.groupBy("query_id", "term").agg(F.sum("docs").alias("df"), F.first("need").alias("need")).crossJoin(F.broadcast(corpus))  # one row
        df = df.withColumn("idf", F.log(1 + (F.col("corpus") - F.col("df") + 0.5) / (F.col("df") + 0.5))).select("query_id", "term", "need", "idf", "mean")

        def weight(tf: str, n: str) -> Column:
            return F.col("idf") * F.col(tf) * (k1 + 1) / (F.col(tf) + k1 * (1 - b + b * F.col(n) / F.col("mean")))

        spans = heads.drop("need").join(df, ["query_id", "term"]).groupBy("query_id", "span").agg(F.sum(weight("most_tf", "least_n")).alias("bound"), F.count("*").alias("have"), F.first("need").alias("need"))
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "span"))
        spans = spans.filter("have = need").select("query_id", "span", "bound")

        def scored(of: DataFrame) -> DataFrame:
            posts = of.select("query_id", "span").join(df, "query_id").join(blocks.select("term", "span", "posts"), ["term", "span"]).select("query_id", "need", "idf", "mean", F.explode("posts").alias("p"))
            posts = posts.select("query_id", "need", "idf", "mean", "p.*")
            found = posts.groupBy("query_id", "doc_id").agg(F.round(F.sum(weight("tf", "n")), 6).alias("score"), F.count("*").alias("have"), F.first("need").alias("need"))
            return found.filter("have = need").select("query_id", "doc_id", "score")

        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
        first = spans.withColumn("place", place).filter(F.col("place") <= probe)
        least = scored(first).withColumn("rank", rank).filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
        spans = spans.join(least, "query_id", "left").join(first.select("query_id", "span", F.lit(True).alias("first")), ["query_id", "span"], "left")
        spans = spans.withColumn("opened", F.coalesce("first", F.lit(False)) | F.col("least").isNull() | (F.col("bound") + 1e-6 >= F.col("least"))).select("query_id", "span", "bound", "opened")
        return spans, scored(spans.filter("opened"))

    def search(self, queries: DataFrame, k: int, **weights: float) -> DataFrame:
        """query_id, rank, doc_id, score: the k best documents that hold every word of a query(query_id, query), by BM25, ties by doc_id."""
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
        return self.plan(queries, k, **weights)[1].withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
