"""Joins by identifier: fallback chains, defaults, hierarchies, gap filling and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.rank import top_n
from tallyframe.operators.staging import staged, tasks_for

#: Rows of sets that one task tells apart and sorts.
MEMBERS_PER_TASK = 2_000_000
#: Pairs of sets that one task makes and counts, without spilling, and that one task sends; the pairs of a set of more members than HOT_MEMBERS are
#: counted by several tasks.
PAIRS_PER_TASK, PAIRS_PER_SENDER = 2_000_000, 8_000_000
HOT_MEMBERS = 50_000
#: Rows of one prefix that a name meets at once.
ROWS_PER_PART = 200
#: Slices of the names that meet one part, and matches that one task makes.
NAME_SLICES, MATCHES_PER_TASK = 8, 20_000_000


def _stripped(x: Column) -> Column:
    return F.regexp_replace(x, r"_\d+$", "")


def stripped_then_bar(x: Column) -> list[Column]:
    """Candidates for an item id: without its number; before the first bar."""
    return [_stripped(x), F.substring_index(x, "|", 1)]


def exact_then_stripped(x: Column) -> list[Column]:
    """Candidates: the id itself; without its number; before the first bar."""
    return [x, _stripped(x), F.substring_index(x, "|", 1)]


def resolve(df: DataFrame, id_col: str, labels: DataFrame, label_col: str, candidates: Sequence[Column], default: Column, out: str = "resolved") -> DataFrame:
    """df with `out`: the first candidate that labels has, else the default.

    Distinct ids alone go through the lookup, one row for each candidate, so a hot id costs one probe.
    """
    ids = df.select(id_col).distinct()
    tried = ids.select(id_col, F.posexplode(F.array(*candidates)).alias("_pos", "_cand"))
    known = labels.select(F.col(label_col).alias("_cand")).distinct()
    hit = tried.join(known, "_cand").groupBy(id_col).agg(F.min(F.struct("_pos", "_cand")).alias("_hit"))
    found = ids.join(hit, id_col, "left").select(id_col, F.coalesce("_hit._cand", default).alias(out))
    return df.join(found, id_col)


def left_default(df: DataFrame, dim: DataFrame, on: str, **defaults: Column) -> DataFrame:
    """Left join with a default for each named column."""
    joined = df.join(dim, on, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def semi_either(df: DataFrame, keys: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows with any of the columns among the keys: one equi-join for each column, never an OR join."""
    known = keys.select(F.col(key).alias("_k")).distinct()
    out, rest = None, df
    for c in columns:
        hit = rest.join(known, rest[c] == known["_k"], "left_semi")
        out = hit if out is None else out.unionByName(hit)
        rest = rest.join(known, rest[c] == known["_k"], "left_anti")
    return out


def prefix_counts(df: DataFrame, name: str, item: str, prefixes: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(keys, prefix, n): distinct items under each of a fixed list of name prefixes."""
    hit = F.filter(F.array(*(F.lit(p) for p in prefixes)), lambda p: F.startswith(F.col(name), p))
    return df.select(*keys, item, F.explode(hit).alias("prefix")).groupBy(*keys, "prefix").agg(F.count_distinct(item).alias("n"))


def shared_members(sets: DataFrame, set_col: str, member: str, most_sets: int) -> DataFrame:
    """(a, b, shared, overlap) with a < b: members in common and shared / smaller size; members of more than most_sets sets are ignored.

    most_sets is part of the definition; it bounds the pairs from one member. Pairs are never shuffled: a member's sets are listed by size, so the
    first of a pair is the smaller one, and each set is sent with its size and the sets listed after it to the task that counts its pairs.
    """
    rows = sets.select(F.col(set_col).alias("_s"), F.col(member).alias("_m"))
    # rows are dealt by their number before copies are dropped and members sorted: a task that does so for a whole split of a file spills
    distinct = rows.repartition(tasks_for(sets.sparkSession, rows.count(), MEMBERS_PER_TASK), "_s", "_m").distinct()
    sizes = staged(distinct.where(F.col("_s").isNotNull()).groupBy("_s").agg(F.count("*").alias("_n")), "set-sizes")
    sized = distinct.where(F.col("_m").isNotNull()).join(sizes, "_s", "left")
    few = top_n(sized, ["_m"], [F.col("_n").asc(), F.col("_s").asc()], most_sets + 1)
    listed = F.array_sort(F.collect_list(F.when(F.col("_s").isNotNull(), F.struct("_n", "_s"))))
    few = few.groupBy("_m").agg(F.count("*").alias("_k"), listed.alias("_l")).where(F.col("_k").between(2, most_sets))
    few = staged(few.select("_m", "_l"), "shared-members")
    n_pairs = few.agg(F.sum((F.size("_l") * (F.size("_l") - 1.0)) / 2)).first()[0] or 0
    n_tasks = lambda each: tasks_for(sets.sparkSession, n_pairs, each)
    after = F.transform("_l", lambda x, i: F.struct(x["_s"].alias("_s"), x["_n"].alias("_n"), F.slice(F.col("_l._s"), i + 2, most_sets).alias("_after")))
    heads = few.repartition(n_tasks(PAIRS_PER_SENDER), "_m").select(F.inline(after)).where(F.size("_after") > 0)
    # the sets that follow a large one are dealt to several tasks, each of which counts its pairs whole
    n_parts = F.ceil(F.col("_n") / HOT_MEMBERS).cast("int")
    split = F.transform(F.sequence(F.lit(0), n_parts - 1), lambda p: F.struct(p.alias("_part"), F.filter("_after", lambda x: F.pmod(F.xxhash64(x), n_parts) == p).alias("_after")))
    whole = F.array(F.struct(F.lit(0).alias("_part"), F.col("_after")))
    dealt = heads.select("_s", "_n", F.inline(F.when(n_parts > 1, split).otherwise(whole))).repartition(n_tasks(PAIRS_PER_TASK), "_s", "_part")
    pairs = dealt.select("_s", "_n", "_part", F.explode("_after").alias("_t")).groupBy("_s", "_n", "_part", "_t").agg(F.count("*").alias("shared"))
    return pairs.select(F.least("_s", "_t").alias("a"), F.greatest("_s", "_t").alias("b"), "shared", (F.col("shared") / F.col("_n")).alias("overlap"))


def nested_fallback(df: DataFrame, narrow: DataFrame, narrow_on: str, wide: DataFrame, wide_on: str, columns: Sequence[str]) -> DataFrame:
    """The columns of the narrow dimension where it has the row, else of the wide one; group_level says which."""
    a = narrow.select(narrow_on, F.struct(*columns).alias("_narrow"))
    b = wide.select(wide_on, F.struct(*columns).alias("_wide"))
    joined = df.join(a, narrow_on, "left").join(b, wide_on, "left")
    level = F.when(F.col("_narrow").isNotNull(), narrow_on).when(F.col("_wide").isNotNull(), wide_on).otherwise("unavailable")
    pick = F.coalesce("_narrow", "_wide")
    return joined.select(*df.columns, level.alias("group_level"), *(pick[c].alias(c) for c in columns))


def partition_fallback(stats: DataFrame, key: str, part: str, wanted, order: Sequence[Column]) -> DataFrame:
    """Each key's row of the wanted partition, else its first row of any other by order."""
    own = F.when(F.col(part) == wanted, 0).otherwise(1)
    return top_n(stats, [key], [own.asc(), *order])


def grid_fill(cells: DataFrame, rows: DataFrame, row: str, columns: DataFrame, column: str, fills: dict[str, Column]) -> DataFrame:
    """Every row with every column of a small dimension (columns, one row a column); missing cells get their fill."""
    grid = rows.select(row).distinct().crossJoin(columns)
    extra = [c for c in columns.columns if c != column]
    joined = grid.join(cells, [row, column], "left")
    return joined.select(row, column, *extra, *(F.coalesce(F.col(c), f).alias(c) for c, f in fills.items()))


def mapped(df: DataFrame, col: str, mapping: DataFrame, source: str, target: str) -> DataFrame:
    """col renamed through mapping, itself where mapping lacks it."""
    m = mapping.select(F.col(source).alias("_s"), F.col(target).alias("_t"))
    return df.join(m, df[col] == m["_s"], "left").withColumn(col, F.coalesce("_t", col)).drop("_s", "_t")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """new's rows override old's by key."""
    return new.unionByName(old.join(new.select(*keys).distinct(), list(keys), "left_anti"), allowMissingColumns=True)


def combined_runs(expected: DataFrame, old: DataFrame, new: DataFrame, key: str, status: str = "status") -> DataFrame:
    """upsert() of two runs, and a row of status 'missing_summary' for each key of expected that neither has."""
    have = upsert(old, new, [key])
    lost = expected.select(key).distinct().join(have.select(key), key, "left_anti").withColumn(status, F.lit("missing_summary"))
    return have.unionByName(lost, allowMissingColumns=True)


def unresolved(evidence: DataFrame, id_col: str, aliases: DataFrame, alias: str, target: str, active: DataFrame, active_col: str) -> DataFrame:
    """(status, id): evidence ids that resolve to no active one, and active ids without evidence."""
    via = mapped(evidence.select(id_col).distinct(), id_col, aliases, alias, target).distinct()
    live = active.select(F.col(active_col).alias(id_col)).distinct()
    lost = via.join(live, id_col, "left_anti").select(F.lit("unresolved").alias("status"), F.col(id_col).alias("id"))
    return lost.unionByName(live.join(via, id_col, "left_anti").select(F.lit("no_evidence").alias("status"), F.col(id_col).alias("id")))


def donors(bases: DataFrame, pool: DataFrame, key: str, family: str, order: str, size: str, largest: bool = True) -> DataFrame:
    """(key, related, divergent): a relative of the same family, else of the same order, and one of another order, by size.

    A pool's best two per family, per order and overall per order suffice to leave the base itself out, so no base meets the whole pool.
    """
    slim = pool.select(F.col(key).alias("_d"), F.col(family).alias("_f"), F.col(order).alias("_o"), F.col(size).alias("_s"))
    rank = [F.col("_s").desc() if largest else F.col("_s").asc(), F.col("_d").asc()]

    def near(on: str, col: str, name: str) -> DataFrame:
        two = top_n(slim, [on], rank, 2)
        met = bases.select(key, col).join(two, F.col(col) == F.col(on)).where(F.col(key) != F.col("_d"))
        return top_n(met, [key], rank).select(key, F.col("_d").alias(name))

    # the leaders of two orders suffice: one of them is not the base's
    leaders = top_n(slim, ["_o"], rank).orderBy(*rank).limit(2)
    leaders = leaders.agg(F.array_sort(F.collect_list(F.struct((-F.col("_s") if largest else F.col("_s")).alias("s"), F.col("_d").alias("d"), F.col("_o").alias("o")))).alias("_l"))
    out = bases.select(key, order).join(F.broadcast(leaders)).select(key, F.try_element_at(F.filter("_l", lambda x: x["o"] != F.col(order)), F.lit(1))["d"].alias("divergent"))
    return (
        out.join(near("_f", family, "_fam"), key, "left").join(near("_o", order, "_ord"), key, "left")
        .select(key, F.coalesce("_fam", "_ord").alias("related"), "divergent")
    )


def prefix_join(names: DataFrame, name: str, prefixes: DataFrame, prefix: str) -> DataFrame:
    """names' and prefixes' columns for each name that starts with a prefix. Column names must differ; null matches nothing.

    A name is cut at each length that some prefix has, as many as the longest prefix has characters, and met by equality. Rows of one prefix
    are dealt to parts of about ROWS_PER_PART, which names meet as arrays, and names to slices, so that a prefix of many rows and many names is
    shared by many tasks.
    """
    lengths = [r[0] for r in prefixes.where(F.col(prefix).isNotNull()).select(F.length(prefix)).distinct().collect()]
    cuts = F.filter(F.array(*(F.lit(n) for n in sorted(lengths))).cast("array<int>"), lambda n: n <= F.length(name))
    heads = names.withColumn("_head", F.explode(F.transform(cuts, lambda n: F.substring(F.col(name), F.lit(1), n))))
    kinds = prefixes.where(F.col(prefix).isNotNull()).groupBy(F.col(prefix).alias("_head")).agg(F.count("*").alias("_n"))
    kinds = staged(kinds.withColumn("_parts", F.ceil(F.col("_n") / ROWS_PER_PART).cast("int")), "prefix-kinds")
    row = F.struct(*prefixes.columns)
    parts = prefixes.join(kinds, F.col(prefix) == F.col("_head")).select("_head", F.pmod(F.xxhash64(row), "_parts").cast("int").alias("_part"), row.alias("_row"))
    parts = parts.groupBy("_head", "_part").agg(F.collect_list("_row").alias("_rows"))
    parts = parts.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(NAME_SLICES - 1))))
    met = heads.join(kinds, "_head")
    n_tasks = tasks_for(names.sparkSession, met.agg(F.sum("_n")).first()[0] or 0, MATCHES_PER_TASK)
    met = met.withColumns({"_part": F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)), "_slice": F.pmod(F.xxhash64(*names.columns), F.lit(NAME_SLICES)).cast("int")})
    keys = ["_head", "_part", "_slice"]
    return met.repartition(n_tasks, *keys).join(parts, keys).select(*names.columns, F.inline("_rows"))
