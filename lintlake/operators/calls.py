"""Ranked call sites of functions.

The question is a join of functions and call lines on the name, cut to the best N per
function. A popular name can hold a third of both sides, so the pairs are never formed.
The score of a pair depends on three facts only: same folder (+3) or same top module
(+1), and header included (+3). So call lines are filed into buckets

    (name, scope, area, stem)   area: any | module | folder    stem: any | header stem

and each bucket keeps its first N lines in (file, line) order. Every line before a line
in its most specific bucket scores at least as much, hence a line outside a bucket's
first N has N better ones there: the union of the buckets a function looks into contains
its exact top N. The cut is a rank limit, applied in every task before the shuffle.

A call line travels as (file, line) through filing and ranking. Its text is read from its
file again, with the lines around it, for the ranked sites only.

`scope` carries the class rule: lines without a class qualifier are open to all
functions; a qualified line is open to functions without a class and to those whose
class it names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lintlake.functions import code
from lintlake.functions import text as tx
from lintlake.operators.context import window_text
from lintlake.operators.skew import PARTS, dealt, hot_keys, repeated, spread_join
from lintlake.operators.staging import bytes_of, hand_over, new_folder, write_over

PROFILE = ("name", "class_name", "def_dir", "stem")
OPEN, UNCLASSED = "any", "none"


def profiles(anchors: DataFrame) -> DataFrame:
    """Anchors (name, class_name, def_file) → what the call search depends on, with `count`."""
    return (
        anchors.where(F.col("name").isNotNull())
        .select(
            "name",
            F.coalesce("class_name", F.lit("")).alias("class_name"),
            tx.dir_name(F.col("def_file")).alias("def_dir"),
            tx.file_stem(F.col("def_file")).alias("stem"),
        )
        .groupBy(*PROFILE)
        .count()
    )


def call_lines(sources: DataFrame, longest: DataFrame | None = None) -> DataFrame:
    """Per searched file: path, include block and array of struct(line, code, names).

    `longest` has one row (name, stem): lengths that bound the work on very long tokens.
    The length for stems is handed on as `longest_stem`.
    """

    def bound(name: str) -> Column:
        # A subquery cannot stand inside a lambda function, so it gets a column of its own.
        return F.lit(code.MAX_ARRAY) if longest is None else F.coalesce(longest.select(name).scalar(), F.lit(0))

    searched = sources.where(code.is_searched_file(F.col("file_path"))).select(
        F.col("file_path").alias("file"),
        tx.bare_split(F.col("text")).alias("_bare"),
        bound("name").alias("_longest"),
        bound("stem").alias("longest_stem"),
    )
    calls = F.filter(
        F.transform(
            "_bare",
            lambda t, i: F.when(
                F.contains(t, F.lit("(")),
                F.struct(
                    (i + 1).alias("line"),
                    tx.strip(t).alias("code"),
                    code.called_names(t, F.col("_longest")).alias("names"),
                ),
            ),
        ),
        lambda c: F.size(c["names"]) > 0,
    )
    return searched.select(
        "file",
        "longest_stem",
        code.include_block(F.col("_bare")).alias("includes"),
        calls.alias("calls"),
    )


def _tokens(files: DataFrame) -> DataFrame:
    """(file, line, code, name): call lines, definitions left out.

    Outer explodes keep the optimizer from adding a size filter that would compute the
    call arrays twice.
    """
    return (
        files.select("file", *[c for c in files.columns if c not in ("file", "calls", "includes", "longest_stem")],
                     F.explode_outer("calls").alias("c"))
        .where("c is not null")
        .select("*", F.col("c.line").alias("line"), F.col("c.code").alias("code"),
                F.explode_outer("c.names").alias("name"))
        .drop("c")
        .where(~code.defines(F.col("code"), F.col("name")))
    )


def _scopes() -> Column:
    """The scopes a call line is open to."""
    qualifier = code.other_class_qualifier(F.col("code"), F.col("name"))
    return F.when(qualifier.isNull(), F.array(F.lit(OPEN))).otherwise(
        F.array_distinct(
            F.concat(
                F.array(F.lit(UNCLASSED), F.concat(F.lit("="), qualifier)),
                F.transform(
                    code.qualifier_endings(F.col("code"), F.col("name")),
                    lambda c: F.concat(F.lit("="), c),
                ),
            )
        )
    )


def _key(name: Column, scope: Column, area: Column, stem: Column) -> Column:
    return F.struct(
        name.alias("name"), scope.alias("scope"), area.alias("area"), stem.alias("stem")
    )


def _areas(module: Column, folder: Column) -> Column:
    return F.array(
        F.lit(""), F.concat(F.lit("m:"), module), F.concat(F.lit("d:"), folder)
    )


def rank_call_sites(
    anchors: DataFrame,
    sources: DataFrame,
    max_call_sites: int | None = 20,
    context_window: int = 6,
    with_context: bool = True,
) -> DataFrame:
    """Best call sites per distinct (name, class_name, def_dir, stem), flat, with their rank.

    `max_call_sites=None` keeps every call site: the result then is as large as the number
    of pairs, so ask for it only where that is wanted.
    """
    return rank_for_profiles(
        hand_over(profiles(anchors), "profiles"), sources, max_call_sites, context_window, with_context
    )


def rank_for_profiles(
    wanted: DataFrame,
    sources: DataFrame,
    max_call_sites: int | None,
    context_window: int,
    with_context: bool = True,
) -> DataFrame:
    """`rank_call_sites` for profiles that are already a table: they are read several times."""
    top = _ranked_sites(wanted, sources, max_call_sites, with_context)
    return _attach_context(top, sources, context_window) if with_context else top


def _paths_repeat(sources: DataFrame) -> bool:
    """Whether some path names several texts; one job over the paths alone."""
    again = sources.groupBy("file_path").count().where("file_path is not null and count > 1")
    return not again.isEmpty()


def _ranked_sites(wanted: DataFrame, sources: DataFrame, max_call_sites: int | None, code_later: bool) -> DataFrame:
    """The ranked sites without context. With `code_later` they come without `code`, unless a
    path names several texts, so that a file and a line do not tell the code."""
    longest = wanted.agg(F.max(F.length("name")).alias("name"), F.max(F.length("stem")).alias("stem"))
    files = call_lines(sources, longest)
    if max_call_sites is None:
        return _all_pairs(wanted, files)
    return top_pairs(wanted, _filed(wanted, files, not code_later or _paths_repeat(sources)), max_call_sites)


def relevant_stems(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """(file, stems): header stems of wanted profiles the file includes.

    The list of a file is bounded by its own include block.
    """
    return (
        files.select(
            "file", F.explode_outer(code.included_stems(F.col("includes"), F.col("longest_stem"))).alias("stem")
        )
        .join(wanted.select("stem").where("stem <> ''").distinct(), "stem", "left_semi")
        .groupBy("file")
        .agg(F.collect_set("stem").alias("stems"))
    )


BUCKET = ("name", "scope", "area", "bucket_stem")


def _filed(wanted: DataFrame, files: DataFrame, keep_code: bool) -> DataFrame:
    """Call lines of wanted names, one row per bucket they are filed into."""
    tokens = with_scopes(_tokens(files.select("file", "calls")), keep_code)
    return in_buckets(tokens.join(wanted.select("name").distinct(), "name", "left_semi"), relevant_stems(files, wanted))


def with_scopes(tokens: DataFrame, keep_code: bool, *more: str) -> DataFrame:
    """Call lines (name, file, line, code) → + `scopes`, with the columns `more`; the code goes before any shuffle."""
    kept = ["name", "file", "line", *more, *["code"] * keep_code]
    return tokens.select(*kept, _scopes().alias("scopes"))


def in_buckets(tokens: DataFrame, stems: DataFrame) -> DataFrame:
    """Call lines (name, file, line, scopes and perhaps code), one row per bucket; `stems` is by file."""
    no_stems = F.array().cast("array<string>")
    return (
        tokens.join(stems, "file", "left")
        .withColumn("stems", F.coalesce("stems", no_stems))
        .select("*", F.explode_outer("scopes").alias("scope"))
        .select(
            "*",
            F.explode(_areas(tx.top_module(F.col("file")), tx.dir_name(F.col("file")))).alias(
                "area"
            ),
        )
        .select(
            "name",
            "scope",
            "area",
            F.explode(F.concat(F.array(F.lit("")), "stems")).alias("bucket_stem"),
            "file",
            "line",
            *[c for c in tokens.columns if c == "code"],
        )
    )


def _lookups(wanted: DataFrame) -> DataFrame:
    """The buckets each profile looks into."""
    in_folder = F.col("def_dir") != ""
    module = tx.top_module(F.col("def_dir"))
    areas = F.when(in_folder, _areas(module, F.col("def_dir"))).otherwise(F.array(F.lit("")))
    stems = F.when(F.col("stem") != "", F.array(F.lit(""), F.col("stem"))).otherwise(
        F.array(F.lit(""))
    )
    own_scope = F.when(F.col("class_name") == "", F.lit(UNCLASSED)).otherwise(
        F.concat(F.lit("="), F.col("class_name"))
    )
    return (
        wanted.select(*PROFILE, F.explode(F.array(F.lit(OPEN), own_scope)).alias("scope"),
                      areas.alias("_a"), stems.alias("_s"))
        .select(*PROFILE, "scope", F.explode("_a").alias("area"), "_s")
        .select(*PROFILE, "scope", "area", F.explode("_s").alias("bucket_stem"))
    )


def count_call_sites(anchors: DataFrame, sources: DataFrame) -> DataFrame:
    """Call sites per profile and score, all of them: (name, class_name, def_dir, stem, score, n).

    No pair is formed: lines are counted per bucket, and since a folder lies in its module
    and a module in the whole, the counts of a score are differences of bucket counts.
    """
    wanted = hand_over(profiles(anchors), "profiles")
    longest = wanted.agg(F.max(F.length("name")).alias("name"), F.max(F.length("stem")).alias("stem"))
    sizes = _filed(wanted, call_lines(sources, longest), False).groupBy(*BUCKET).agg(F.count("*").alias("n"))
    found = spread_join(_lookups(wanted), sizes, list(BUCKET), list(PROFILE), how="inner")
    kinds = {"all": F.col("area") == "", "module": F.startswith("area", F.lit("m:")), "folder": F.startswith("area", F.lit("d:"))}
    sums = []
    for kind, inside in kinds.items():
        for header, hit in (("with", F.col("bucket_stem") != ""), ("any", F.col("bucket_stem") == "")):
            sums.append(F.sum(F.when(inside & hit, F.col("n")).otherwise(0)).alias(f"{kind}_{header}"))
    counted = found.groupBy(*PROFILE).agg(*sums)

    def rows(folder: bool, module: bool, wider: str | None, kind: str) -> list[Column]:
        out = []
        for header in (True, False):
            own = F.col(f"{kind}_with") if header else F.col(f"{kind}_any") - F.col(f"{kind}_with")
            if wider:
                own = own - (F.col(f"{wider}_with") if header else F.col(f"{wider}_any") - F.col(f"{wider}_with"))
            score = code.call_site_score(F.lit(folder), F.lit(module), F.lit(header))
            out.append(F.struct(score.alias("score"), own.alias("n")))
        return out

    by_score = [*rows(True, True, None, "folder"), *rows(False, True, "folder", "module"), *rows(False, False, "module", "all")]
    return counted.select(*PROFILE, F.inline(F.array(*by_score))).where("n > 0")


def top_pairs(wanted: DataFrame, filed: DataFrame, limit: int) -> DataFrame:
    """The best `limit` sites of every profile, with `code` where the filed lines have it."""
    key = list(BUCKET)
    carried = [c for c in filed.columns if c == "code"]
    in_order = Window.partitionBy(*key).orderBy("file", "line")
    lookups = _lookups(wanted)
    # Most buckets are those of folders and headers that no profile asks for.
    heads = (
        filed.withColumn("_n", F.row_number().over(in_order))
        .where(F.col("_n") <= limit)
        .join(lookups.select(*key).distinct(), key, "left_semi")
        .groupBy(*key)
        .agg(F.collect_list(F.struct("file", "line", *carried)).alias("sites"))
    )
    candidates = (
        spread_join(lookups, heads, key, list(PROFILE), how="inner")
        .select(*PROFILE, "bucket_stem", F.explode("sites").alias("s"))
        .select(*PROFILE, "bucket_stem", "s.*")
        # One shuffle serves the grouping and the ranking below.
        .repartition(*PROFILE)
        .groupBy(*PROFILE, "file", "line")
        .agg(
            *[F.first(c).alias(c) for c in carried],
            F.max(F.col("bucket_stem") != "").alias("includes_bug_header"),
        )
    )
    return _ranked(candidates).where(F.col("rank") <= limit)


def _all_pairs(wanted: DataFrame, files: DataFrame) -> DataFrame:
    tokens = _tokens(files.select("file", "calls", F.col("includes").alias("_inc"))).join(
        wanted.select("name").distinct(), "name", "left_semi"
    )
    pairs = spread_join(tokens, wanted, ["name"], ["file", "line"], how="inner")
    qualifier = code.other_class_qualifier(F.col("code"), F.col("name"))
    same_class = F.contains(
        F.col("code"), F.concat(F.col("class_name"), F.lit("::"), F.col("name"))
    )
    own = (F.col("class_name") == "") | qualifier.isNull() | same_class | (
        qualifier == F.col("class_name")
    )
    return _ranked(
        pairs.where(own).select(
            *PROFILE,
            "file",
            "line",
            "code",
            code.includes_header(F.col("_inc"), F.col("stem")).alias("includes_bug_header"),
        )
    )


def _ranked(sites: DataFrame) -> DataFrame:
    in_folder = F.col("def_dir") != ""
    scored = sites.select(
        "*",
        (in_folder & (tx.dir_name(F.col("file")) == F.col("def_dir"))).alias("same_dir"),
        (in_folder & (tx.top_module(F.col("file")) == tx.top_module(F.col("def_dir")))).alias(
            "same_top_module"
        ),
    ).withColumn(
        "score",
        code.call_site_score(
            F.col("same_dir"), F.col("same_top_module"), F.col("includes_bug_header")
        ),
    )
    best = Window.partitionBy(*PROFILE).orderBy(F.desc("score"), "file", "line")
    return scored.withColumn("rank", F.row_number().over(best))


def _attach_context(sites: DataFrame, sources: DataFrame, around: int) -> DataFrame:
    """Add the code of each call, the lines around it and the include block of its file.

    Each file is one row on the right; a file many sites point at is split by the adaptive
    skew join.
    """
    files = sources.select(
        F.col("file_path").alias("file"), tx.bare_split(F.col("text")).alias("_bare")
    ).withColumn("includes", code.include_block(F.col("_bare")))
    return with_windows(sites, files, around)


def with_windows(sites: DataFrame, files: DataFrame, around: int) -> DataFrame:
    """Sites and files (file, _bare, includes) → sites with code, context and includes."""
    around_call = window_text(F.col("_bare"), F.col("line"), F.col("line"), around, bare=True)
    own = F.col("code") if "code" in sites.columns else tx.strip(F.get("_bare", F.col("line") - 1))
    columns = [c for c in sites.columns if c != "code"]
    place = columns.index("line") + 1
    return sites.join(files, "file").select(
        *columns[:place],
        own.alias("code"),
        *columns[place:],
        around_call["start_line"].alias("context_start"),
        around_call["end_line"].alias("context_end"),
        around_call["code"].alias("context"),
        "includes",
    )


CALL_SITE = (
    "file",
    "line",
    "code",
    "context_start",
    "context_end",
    "context",
    "includes",
    "includes_bug_header",
    "same_dir",
    "same_top_module",
    "score",
)


#: Rounds in which the lists of large tables are made, and handed-over bytes of site texts for a round.
ROUNDS = 8
ROUND_BYTES = 64 << 20


def attach_call_sites(
    bugs: DataFrame,
    sources: DataFrame,
    max_call_sites: int = 20,
    context_window: int = 6,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Bugs with `anchor` → `anchors`: array of the anchor with its ranked `call_sites`.

    The nested list holds at most `max_call_sites` sites; for all of them use the flat
    `rank_call_sites`.

    `then` is what comes of the bugs row by row, such as their prompts. The lists are many
    times the sources, so where they are large it is made and handed over in rounds of
    profiles: the disk holds the shuffled texts of one round, and no list.
    """
    # Read for the profiles, for the bugs with an anchor and for those without.
    bugs = hand_over(bugs, "anchored-bugs")
    found = bugs.where("anchor is not null")
    wanted = hand_over(profiles(found.select("anchor.*")), "profiles")
    keys = [f"_{c}" for c in PROFILE]
    counts = wanted.select(*[F.col(c).alias(f"_{c}") for c in PROFILE], "count")
    hot = F.broadcast(hot_keys(counts, keys, PARTS))
    hot_names = F.broadcast(
        hot_keys(counts.groupBy("_name").agg(F.sum("count").alias("count")), ["_name"], PARTS)
        .withColumnRenamed("_slices", "_seats")
    )

    def seated(rows: DataFrame) -> DataFrame:
        """Rows with a profile and its `_slice` → + `_seat`: a popular name is dealt by its profiles."""
        deal = F.coalesce(F.pmod(F.xxhash64(*keys, "_slice"), F.col("_seats")), F.lit(0))
        seat = F.when(F.col("_name").isNull(), F.col("_slice")).otherwise(deal).cast("int")
        return rows.join(hot_names, "_name", "left").withColumn("_seat", seat).drop("_seats")

    # What ranking has shuffled is gone when the texts are read.
    top = hand_over(_ranked_sites(wanted, sources, max_call_sites, True), "ranked-sites")
    top = top.withColumnsRenamed({c: f"_{c}" for c in PROFILE})
    texts = hand_over(_site_texts(seated(repeated(top.dropna(subset=keys), hot, keys)), sources, context_window), "site-texts")
    keyed = found.withColumns(
        {
            "_name": F.col("anchor.name"),
            "_class_name": F.coalesce("anchor.class_name", F.lit("")),
            "_def_dir": tx.dir_name(F.col("anchor.def_file")),
            "_stem": tx.file_stem(F.col("anchor.def_file")),
        }
    )
    reader = texts.schema["_readers"].dataType.elementType
    own = {*keys[1:], "_slice"}
    itself = F.array(F.struct(
        *[F.col(f.name) if f.name in own else F.lit(None).cast(f.dataType).alias(f.name) for f in reader.fields]
    ))
    askers = seated(dealt(keyed, hot, keys, ["issue_key"])).select(
        "_name", "_seat", itself.alias("_readers"), F.lit(True).alias("_asks"), *[F.col(f"`{c}`") for c in bugs.columns]
    )
    site_fields = texts.schema["_site"].dataType.names
    site = F.when(~F.col("_asks"), F.struct(F.col("_r.rank").alias("rank"), *[
        (F.col("_site")[c] if c in site_fields else F.col("_r")[c]).alias(c) for c in CALL_SITE
    ]))
    # The sites of a seat's profile come first, so every bug after them sees them all.
    before = Window.partitionBy("_name", "_seat", *keys[1:], "_slice").orderBy("_asks").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    kept = [F.col(f"`{c}`") for c in bugs.columns if c != "anchor"]
    sites = F.transform(F.array_sort("_sites"), lambda s: F.struct(*[s[c].alias(c) for c in CALL_SITE]))
    fields = bugs.schema["anchor"].dataType.names
    full = F.array(F.struct(*[F.col(f"anchor.{f}").alias(f) for f in fields], sites.alias("call_sites")))

    def listed(part: Column) -> DataFrame:
        # A site's text goes once to a seat and is given to its readers there; the bugs sit beside
        # it, so the texts are not shuffled for every function that shows them.
        together = (
            texts.where(part)
            .withColumn("_asks", F.lit(False))
            .unionByName(askers.where(part), allowMissingColumns=True)
            .repartition("_name", "_seat")
            .withColumn("_r", F.explode("_readers"))
            .drop("_readers")
            .select("*", *[F.col(f"_r.{c}").alias(c) for c in (*keys[1:], "_slice")])
        )
        given = together.withColumn("_one", site).withColumn("_sites", F.collect_list("_one").over(before))
        return given.where("_asks").select(*kept, full.alias("anchors"))

    def unlisted(like: DataFrame) -> DataFrame:
        none = F.array().cast(like.schema["anchors"].dataType)
        return bugs.where("anchor is null").select(*kept, none.alias("anchors"))

    rounds = min(ROUNDS, bytes_of(texts) // ROUND_BYTES + 1) if then else 1
    if rounds == 1:
        whole = listed(F.lit(True))
        whole = whole.unionByName(unlisted(whole))
        return then(whole) if then else whole
    folder, turn = new_folder(bugs.sparkSession, "rounds"), F.pmod(F.xxhash64("_name", "_seat"), F.lit(rounds))
    for i in range(rounds):
        write_over(then(listed(turn == i)), folder, "append")
    return write_over(then(unlisted(listed(F.lit(True)))), folder, "append")


def _site_texts(sites: DataFrame, sources: DataFrame, around: int) -> DataFrame:
    """(_name, _seat, _site, _readers): the text of each site, once for all profiles of a seat that show it.

    A reader is a profile with its slice and what the pair has of its own: rank, score, flags.
    """
    seat = ["_name", "_seat", "file", "line"]
    shown = sites.groupBy(*seat).agg(
        F.collect_list(F.struct(*[c for c in sites.columns if c not in seat])).alias("_readers")
    )
    full = _attach_context(shown, sources, around)
    carried = "code" in sites.columns
    site = [c for c in ("file", "line", "code", "context_start", "context_end", "context", "includes") if c != "code" or not carried]
    return full.select("_name", "_seat", F.struct(*site).alias("_site"), "_readers")
