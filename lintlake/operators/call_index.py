"""A kept index of call lines, so that a run over the same sources reads no source text.

The index is a folder of generations. A generation holds the files that are new or differ in
their text since the one before: a row per file (`files`: hash of the text, include block,
lines) and a row per called name and line (`calls`: the line, and which lines are around it),
filed by a hash of the name and sorted by the name. A file counts in the newest generation that names
it; one that is gone leaves a row that says so. So a changed source replaces its own rows and
touches no other's, and what is written grows with the change, not with the sources.

A search reads the folders that the hashes of its names point at, and of them the row groups
that hold the names. It ranks (file, line) alone and takes the texts of the ranked sites
from the lines of their files, so the lines around calls, many times the sources, are neither
kept nor read for calls that are not shown. `context` is filed where it is the line alone.
Names above `longest` characters are not filed (a token of a minified
file would file each of its endings); a search for one fails instead of missing it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lintlake.functions import code
from lintlake.functions import text as tx
from lintlake.operators import calls
from lintlake.operators.issues import best_row
from lintlake.operators.staging import hand_over, tidy

#: Folders of names in a generation.
SHELVES = 64
LONGEST = 512
FILE = "file string, sha string, gone boolean, includes array<string>, generation int"
LINES = f"{FILE}, lines array<string>"
CALL = (
    "name string, file string, line int, code string, context_start int, context_end int, context string, "
    "text string, generation int, shelf int"
)


def _shelf(name: Column) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(SHELVES)).cast("int")


def _text_id(sha: Column) -> Column:
    """Tells the texts of one path in one update apart."""
    return F.left(sha, F.lit(16))


def _generations(spark: SparkSession, folder: str) -> list[int]:
    """Generations whose files are complete; their list is as long as the history of updates."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    store = paths(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.globStatus(paths(f"{folder}/files/generation=*/_SUCCESS")) or []
    return sorted(int(str(f.getPath().getParent().getName()).split("=")[1]) for f in found)


def _files(spark: SparkSession, folder: str, generations: list[int], schema: str = FILE) -> DataFrame:
    paths = [f"{folder}/files/generation={g}" for g in generations]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{folder}/files").parquet(*paths)


def current_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, sha, gone, includes, generation): the newest row of every file, without those gone."""
    rows = _files(spark, folder, _generations(spark, folder))
    return best_row(rows, ["file"], [F.col("generation")], last=True).where("not gone")


def update(sources: DataFrame, folder: str, around: int = 6, longest: int = LONGEST) -> int:
    """Bring the index under `folder` up to `sources` (file_path, text); returns the generation.

    Files that are not searched for calls (headers, excluded folders) are not filed. The
    files of a generation are written after its calls, so one that is lost on the way does
    not count and is written again.
    """
    spark = sources.sparkSession
    generation = max(_generations(spark, folder), default=0) + 1
    known = current_files(spark, folder).select(F.col("file").alias("file_path"), F.col("sha").alias("_sha"))
    searched = sources.where(code.is_searched_file(F.col("file_path"))).select(
        "file_path", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha")
    )
    both = searched.join(known, "file_path", "full_outer").where("sha is null or _sha is null or sha <> _sha")
    fresh = both.where("sha is not null").select(
        F.col("file_path").alias("file"), "sha", tx.split_lines(F.col("text")).alias("_lines")
    )
    listed = fresh.withColumn("_bare", tx.bare_lines(F.col("_lines")))
    found = F.filter(
        F.transform(
            "_bare",
            lambda t, i: F.when(
                F.contains(t, F.lit("(")),
                F.struct(
                    (i + 1).alias("line"), tx.strip(t).alias("code"), code.called_names(t, longest).alias("names"),
                    t.alias("bare"),
                ),
            ),
        ),
        lambda c: F.size(c["names"]) > 0,
    )
    lines = (
        listed.select("file", "sha", F.size("_bare").alias("n"), F.explode_outer(found).alias("c")).where("c is not null")
        .select("file", "sha", "n", "c.line", "c.code", "c.bare", F.explode_outer("c.names").alias("name"))
        .where(F.length("name") <= longest)
        .where(~code.defines(F.col("code"), F.col("name")))
    )
    first, last = F.greatest(F.lit(1), F.col("line") - around), F.least(F.col("n"), F.col("line") + around)
    rows = lines.select(
        "name", "file", "line", "code", first.alias("context_start"), last.alias("context_end"),
        F.when(first == last, F.col("bare")).alias("context"), _text_id(F.col("sha")).alias("text"),
        _shelf(F.col("name")).alias("shelf"),
    )
    # Every task files what its own files hold, so call lines are not shuffled, and a popular
    # name is dealt by its files; within a task names lie together.
    filed = rows.sortWithinPartitions("shelf", "name", "file", "line")
    with tidy(spark):
        filed.write.mode("overwrite").option("compression", "zstd").partitionBy("shelf").parquet(
            f"{folder}/calls/generation={generation}"
        )
    gone = both.where("sha is null").select(
        F.col("file_path").alias("file"), F.lit(None).cast("string").alias("sha"), F.lit(True).alias("gone"),
        F.lit(None).cast("array<string>").alias("includes"), F.lit(None).cast("array<string>").alias("lines"),
    )
    includes = code.include_block(F.col("_bare"))
    kept = listed.select("file", "sha", F.lit(False).alias("gone"), includes.alias("includes"), F.col("_bare").alias("lines"))
    with tidy(spark):
        kept.unionByName(gone).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/files/generation={generation}")
    return generation


def calls_of(spark: SparkSession, folder: str, names: DataFrame) -> DataFrame:
    """Filed call lines of the names (name), from files as they are now."""
    return _found(spark, folder, names, lambda rows: rows).drop("generation")


def _found(spark: SparkSession, folder: str, names: DataFrame, narrow: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`calls_of` with their generation. `narrow` keeps what is asked for, and name, file, generation and
    shelf, before anything is shuffled."""
    generations = _generations(spark, folder)
    paths = [f"{folder}/calls/generation={g}" for g in generations]
    if not paths:
        return narrow(spark.createDataFrame([], CALL)).drop("shelf")
    rows = spark.read.schema(CALL).option("basePath", f"{folder}/calls").parquet(*paths)
    # A search for few names reads few folders. At most SHELVES numbers come to the driver.
    shelves = [r.shelf for r in names.select(_shelf(F.col("name")).alias("shelf")).distinct().collect()]
    wanted = names.select("name", _shelf(F.col("name")).alias("shelf")).distinct()
    found = narrow(rows.where(F.col("shelf").isin(shelves))).join(wanted, ["shelf", "name"], "left_semi")
    now = best_row(_files(spark, folder, generations), ["file"], [F.col("generation")], last=True)
    return found.join(now.where("not gone").select("file", "generation"), ["file", "generation"], "left_semi").drop("shelf")


def _shown(rows: DataFrame, top: DataFrame) -> DataFrame:
    """The call lines of files and lines that are ranked."""
    return rows.join(top.select("name", "file", "line").distinct(), ["name", "file", "line"], "left_semi")


def rank_call_sites(wanted: DataFrame, folder: str, max_call_sites: int = 20, longest: int = LONGEST) -> DataFrame:
    """As `calls.rank_call_sites`, from the index alone. `wanted` holds profiles and is read several times.

    The ranked sites are handed over, so what their ranking shuffled is gone when their texts are.
    """
    spark = wanted.sparkSession
    too_long = F.concat(F.lit("not in the index, which files shorter names: "), F.left("name", F.lit(80)))
    checked = F.when(F.length("name") > longest, F.raise_error(too_long).cast("string")).otherwise(F.col("name"))
    wanted = wanted.withColumn("name", checked)
    files = current_files(spark, folder).withColumn(
        "longest_stem", F.coalesce(wanted.agg(F.max(F.length("stem"))).scalar(), F.lit(0))
    )
    stems = calls.relevant_stems(files, wanted)
    generations = _generations(spark, folder)
    several = _files(spark, folder, generations).groupBy("file", "generation").count().where("count > 1")
    # Where a path names several texts of one update, a file and a line do not tell the code.
    carried = not several.isEmpty()
    tokens = _found(spark, folder, wanted, lambda rows: calls.with_scopes(rows, carried, "shelf", "generation"))
    top = calls.top_pairs(wanted, calls.in_buckets(tokens.drop("generation"), stems), max_call_sites)
    texts = _files(spark, folder, generations, LINES)
    shown = F.slice("lines", F.col("context_start"), F.col("context_end") - F.col("context_start") + 1)
    shown = F.array_join(shown, "\n")
    place = ["shelf", "name", "file", "line", "generation", "context_start", "context_end"]
    top = hand_over(top, "ranked-sites")
    if carried:
        # A text that comes twice counts once here, since each of its call lines is filed twice.
        of_text = ["file", "generation", "text"]
        texts = texts.withColumn("text", _text_id(F.col("sha"))).groupBy(*of_text).agg(F.first("lines").alias("lines"))
        around = _found(spark, folder, wanted, lambda rows: rows.select(*place, "context", "text")).join(texts, of_text, "left")
        around = around.select("name", "file", "line", *place[-2:], F.coalesce("context", shown).alias("context"))
        return top.join(around, ["name", "file", "line"]).join(files.select("file", "includes"), "file").select(
            *top.columns, *place[-2:], "context", "includes"
        )
    # The code goes with the calls that are shown, and with no other.
    around = _found(spark, folder, wanted, lambda rows: _shown(rows.select(*place, "code"), top))
    sites = top.join(around.select("name", "file", "line", "code", "generation", *place[-2:]), ["name", "file", "line"])
    first = ["name", "file", "line", "code"]
    sites = hand_over(sites.select(*first, *[c for c in sites.columns if c not in first]), "shown-sites")
    before = top.columns.index("line") + 1
    return sites.join(texts.select("file", "generation", "includes", "lines"), ["file", "generation"]).select(
        *top.columns[:before], "code", *top.columns[before:], *place[-2:], shown.alias("context"), "includes"
    )
