"""Delimited token lists: split, global frequency, frequency top-k, expand.

The top-k rule: a list longer than ``k`` is ordered by the token's frequency
in its day (descending; ties keep list order) and cut to ``k``; a list of
``k`` or fewer tokens keeps its own order.  The result is padded to ``k``.

Plan: a list's result depends on its day and its text alone, so equal lists
of a day are first counted as one (rows may repeat, no row key is needed).
Token frequencies are sums over these distinct lists, written once, and
measured.  While they are few (``MAP_TOKENS`` a day and list, ``MAP_BYTES`` in
all) they come back as one map for each day, which is broadcast: each row
orders its own tokens by it, and no row is shuffled.  Beyond that, each day's
``HEAD_TOKENS`` most frequent tokens are broadcast: a list that holds ``k`` of
them or more has its top there, since every other token is less frequent.  Only
the other lists longer than ``k`` are joined to the frequencies, ranked with a
literal group limit, written once, and brought back by (day, digest of the
list).  Lists of at most ``k`` tokens never leave their row.  Groups match null
to null.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemwise.operators.columns import col, drop_strict
from itemwise.session import write_scratch

# Fixed values of the expansion step.
FEATURE_K = 6
FEATURE_NAMES = ["feature1", "feature2", "feature3", "feature4", "feature5", "feature6"]
PAIR_K = 2
PAIR_COLUMNS = ["scenario", "brand_real", "audience"]
DELIMITER = ";"
# A map is searched from its start for each token, so it pays while it is short.
MAP_TOKENS = 2_000
MAP_BYTES = 32 << 20
HEAD_TOKENS = 32
# Pads are null inside the pipeline: a real token may be the text "-1".
PAD = None

_REGEX_META = set(".$|()[]{}^?*+\\")


def split_tokens(c: Column | str, delim: str = DELIMITER) -> Column:
    """Split on a literal delimiter; null stays null, '' gives [''] and a
    trailing delimiter gives an empty last token."""
    c = col(c) if isinstance(c, str) else c
    pattern = delim if (len(delim) == 1 and delim not in _REGEX_META) else "\\Q" + delim + "\\E"
    return F.split(c, pattern, -1)


def token_count(c: Column | str, delim: str = DELIMITER) -> Column:
    """Number of tokens; a null list counts 0."""
    arr = split_tokens(c, delim)
    return F.when(arr.isNull(), F.lit(0)).otherwise(F.size(arr))


def token_frequency(df: DataFrame, column: str, group: Sequence[str] = ("ds",),
                    delim: str = DELIMITER) -> DataFrame:
    """(group..., token, n): token occurrences per group; null lists skipped.
    Combined map-side, so a very frequent token costs one row per task."""
    group = list(group)
    return (df.select(*[col(g) for g in group],
                      F.explode(split_tokens(column, delim)).alias("token"))
              .groupBy(*group, "token").agg(F.count(F.lit(1)).alias("n")))


def top_tokens(freq: DataFrame, k: int = 20, group: Sequence[str] = ()) -> DataFrame:
    """The ``k`` most frequent tokens (ties by token text) per group, with
    their rank.  ``row_number <= k`` is planned as a partial group limit
    before the shuffle, so each task sends at most ``k`` rows per group."""
    w = Window.partitionBy(*[col(g) for g in group]).orderBy(F.desc("n"), F.asc("token"))
    return freq.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _pad(arr: Column, k: int, pad) -> Column:
    filler = F.lit(pad).cast("string")
    return F.concat(arr, F.array_repeat(filler, F.greatest(F.lit(0), F.lit(k) - F.size(arr))))


def _same_group(group: Sequence[str]) -> list[Column]:
    return [col(g).eqNullSafe(col(f"__g_{g}")) for g in group]


def _ordered_by(counts: Column):
    """A list's element as (fewest last, first place first, token)."""
    return lambda t, at: F.struct((-F.try_element_at(counts, t)).alias("n"), at.alias("at"), t.alias("token"))


def _by_map(df: DataFrame, freq: DataFrame, specs: Sequence[tuple[str, int]], group: list[str], delim: str) -> DataFrame:
    """Appends ``__top_i``: the k most frequent tokens of a longer list, by
    the maps of its group."""
    pair = F.struct(F.col("__token"), F.col("__n"))
    maps = freq.groupBy(*[col(g).alias(f"__g_{g}") for g in group]).agg(*[
        F.map_from_entries(F.collect_list(F.when(F.col("__list") == i, pair))).alias(f"__map_{i}")
        for i in range(len(specs))])
    # As many rows as groups, within MAP_BYTES.
    out = df.join(F.broadcast(maps), reduce(lambda a, b: a & b, _same_group(group)), "left")
    for i, (c, k) in enumerate(specs):
        arr = split_tokens(c, delim)
        place = F.transform(arr, _ordered_by(F.col(f"__map_{i}")))
        best = F.transform(F.slice(F.array_sort(place), 1, k), lambda e: e["token"])
        out = out.withColumn(f"__top_{i}", F.when(F.size(arr) > k, best))
    return out.drop(*[f"__g_{g}" for g in group], *[f"__map_{i}" for i in range(len(specs))])


def _heads(freq: DataFrame, group: list[str], n_lists: int, head_tokens: int) -> DataFrame:
    """A map for each group and list of at most ``head_tokens`` tokens and
    their frequencies, all above that of every token left out."""
    by = [col(g) for g in group]
    w = Window.partitionBy(*by, "__list").orderBy(F.desc("__n"), "__token")
    first = freq.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= head_tokens + 1)
    # The token behind the last place, if there is one, is the first left out.
    heads = first.groupBy(*by, "__list").agg(
        F.collect_list(F.struct("__token", "__n")).alias("__head"),
        F.max(F.when(F.col("__rn") > head_tokens, F.col("__n"))).alias("__out"))
    heads = heads.select(*[col(g).alias(f"__g_{g}") for g in group], "__list", F.map_from_entries(F.filter(
        "__head", lambda e: e["__n"] > F.coalesce("__out", F.lit(0)))).alias("__head"))
    return heads.groupBy(*[f"__g_{g}" for g in group]).agg(*[
        F.first(F.when(F.col("__list") == i, F.col("__head")), ignorenulls=True).alias(f"__heads_{i}") for i in range(n_lists)])


def _by_heads(df: DataFrame, heads: DataFrame, specs: Sequence[tuple[str, int]], group: list[str], delim: str) -> DataFrame:
    """Appends ``__head_i``: the k most frequent tokens of a longer list that
    holds k tokens of its group's head; null for the others."""
    out = df.join(F.broadcast(heads), reduce(lambda a, b: a & b, _same_group(group)), "left")
    for i, (c, k) in enumerate(specs):
        arr = split_tokens(c, delim)
        place = F.transform(arr, _ordered_by(F.col(f"__heads_{i}")))
        best = F.slice(F.array_sort(F.filter(place, lambda e: e["n"].isNotNull())), 1, k)
        found = F.transform(best, lambda e: e["token"])
        out = out.withColumn(f"__head_{i}", F.when(F.size(arr) > k, found))
        out = out.withColumn(f"__head_{i}", F.when(F.size(f"__head_{i}") == k, F.col(f"__head_{i}")))
    return out.drop(*[f"__g_{g}" for g in group], *[f"__heads_{i}" for i in range(len(specs))])


def _distinct_lists(df: DataFrame, texts: Sequence[Column], specs: Sequence[tuple[str, int]], group: list[str], delim: str
                    ) -> DataFrame:
    """Equal lists of a group as one row with their count."""
    by = [col(g) for g in group]
    rows = F.array(*[F.struct(F.lit(i).alias("__list"), F.lit(k).alias("__k"), text.alias("__text"))
                     for i, ((_, k), text) in enumerate(zip(specs, texts))])
    return (df.select(*by, F.inline(rows)).where("__text IS NOT NULL")
            .groupBy(*by, "__list", "__k", "__text").agg(F.count(F.lit(1)).alias("__c"))
            .select(*by, "__list", "__k", "__c", F.md5("__text").alias("__md5"), split_tokens("__text", delim).alias("__a")))


def _by_join(df: DataFrame, lists: DataFrame, freq: DataFrame, specs: Sequence[tuple[str, int]], group: list[str]
             ) -> DataFrame:
    """As ``_by_map``, by a join of the longer lists' tokens to the frequencies
    and one ranking."""
    by = [col(g) for g in group]
    freq = freq.withColumnsRenamed({g: f"__g_{g}" for g in group} | {"__list": "__fl", "__token": "__ft"})
    long = lists.where(F.size("__a") > F.col("__k")).select(*by, "__list", "__k", "__md5",
                                                            F.posexplode("__a").alias("__pos", "__token"))
    match = (F.col("__list") == F.col("__fl")) & (F.col("__token") == F.col("__ft"))
    for same in _same_group(group):
        match = match & same
    key = [*by, F.col("__list"), F.col("__md5")]
    w = Window.partitionBy(*key).orderBy(F.desc("__n"), F.asc("__pos"))
    ranked = (long.join(freq, match).withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") <= max(k for _, k in specs)).where(F.col("__rn") <= F.col("__k"))
              .groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("__rn", "__token"))).alias("__top")))
    ranked = write_scratch(ranked, "token-ranks")      # read once for each list column
    out = df
    for i, (c, _) in enumerate(specs):
        best = ranked.where(F.col("__list") == i).select(
            *[col(g).alias(f"__g_{g}") for g in group], F.col("__md5").alias("__m"),
            F.transform("__top", lambda e: e["__token"]).alias(f"__top_{i}"))
        cond = F.md5(col(c)) == F.col("__m")
        for same in _same_group(group):
            cond = cond & same
        out = out.join(best, cond, "left").drop("__m", *[f"__g_{g}" for g in group])
    return out


def topk_lists(df: DataFrame, specs: Sequence[tuple[str, int]], group: Sequence[str] = ("ds",),
               delim: str = DELIMITER, pad=PAD, out_fmt: str = "{}_topk", map_tokens: int = MAP_TOKENS,
               head_tokens: int = HEAD_TOKENS) -> DataFrame:
    """Append one array of exactly ``k`` tokens per (column, k) in ``specs``;
    one frequency aggregate serves all list columns.  ``map_tokens`` = 0 always
    takes the join, ``head_tokens`` = 0 for every longer list."""
    group = list(group)
    specs = [(c, k) for c, k in specs if c in df.columns]
    if not specs:
        return df
    by = [col(g) for g in group]
    lists = _distinct_lists(df, [col(c) for c, _ in specs], specs, group, delim)
    freq = write_scratch(lists.select(*by, "__list", "__c", F.explode("__a").alias("__token"))
                         .groupBy(*by, "__list", "__token").agg(F.sum("__c").alias("__n")), "token-counts")
    size = (freq.groupBy(*by, "__list").agg(F.count(F.lit(1)).alias("tokens"), F.sum(F.octet_length("__token") + 24).alias("bytes"))
            .agg(F.max("tokens").alias("tokens"), F.sum("bytes").alias("bytes")).first())
    # Without groups there is no key to bring a map back by.
    if group and (size["tokens"] or 0) <= map_tokens and (size["bytes"] or 0) <= MAP_BYTES:
        out = _by_map(df, freq, specs, group, delim)
    else:
        heads = group and head_tokens and write_scratch(_heads(freq, group, len(specs), head_tokens), "token-heads")
        size = heads and heads.agg(F.sum(sum((F.coalesce(F.aggregate(
            F.map_keys(f"__heads_{i}"), F.lit(0), lambda n, t: n + F.octet_length(t) + 24), F.lit(0)) for i in range(len(specs))),
            F.lit(64))).alias("bytes")).first()
        if heads and (size["bytes"] or 0) <= MAP_BYTES:
            df = _by_heads(df, heads, specs, group, delim)
            lists = _distinct_lists(df, [F.when(F.col(f"__head_{i}").isNull(), col(c)) for i, (c, _) in enumerate(specs)],
                                    specs, group, delim)
        else:
            df = df.withColumns({f"__head_{i}": F.lit(None).cast("array<string>") for i in range(len(specs))})
        out = _by_join(df, lists, freq, specs, group)
        for i in range(len(specs)):
            out = out.withColumn(f"__top_{i}", F.coalesce(f"__head_{i}", f"__top_{i}")).drop(f"__head_{i}")
    for i, (c, k) in enumerate(specs):
        # __top_i is set exactly for the lists longer than k.
        chosen = F.coalesce(F.col(f"__top_{i}"), split_tokens(c, delim))
        out = out.withColumn(out_fmt.format(c), F.when(col(c).isNull(), F.array_repeat(F.lit(pad).cast("string"), k))
                             .otherwise(_pad(chosen, k, pad))).drop(f"__top_{i}")
    return out


def topk_tokens(df: DataFrame, column: str, k: int, group: Sequence[str] = ("ds",),
                out: str | None = None, delim: str = DELIMITER, pad=PAD) -> DataFrame:
    """Append ``out`` (default ``<column>_topk``): an array of exactly ``k``."""
    return topk_lists(df, [(column, k)], group, delim, pad, out if out else "{}_topk")


def expand_lists(df: DataFrame, specs: Sequence[tuple[str, int, Sequence[str]]],
                 group: Sequence[str] = ("ds",), delim: str = DELIMITER, pad=PAD) -> DataFrame:
    """Replace each list column by ``k`` named columns of its top-k tokens;
    a column that is absent is skipped with a warning."""
    present = []
    for c, k, names in specs:
        if c not in df.columns:
            warnings.warn(f"no list column {c!r} to expand", stacklevel=2)
            continue
        present.append((c, k, list(names)))
    if not present:
        return df
    out = topk_lists(df, [(c, k) for c, k, _ in present], group, delim, pad, "__{}_topk")
    out = out.select("*", *[F.col(f"__{c}_topk")[i].alias(n)
                            for c, _, names in present for i, n in enumerate(names)])
    return drop_strict(out, [f"__{c}_topk" for c, _, _ in present] + [c for c, _, _ in present])


def expand_list(df: DataFrame, column: str, k: int, names: Sequence[str],
                group: Sequence[str] = ("ds",), delim: str = DELIMITER, pad=PAD) -> DataFrame:
    """Replace a list column by ``k`` columns holding its top-k tokens."""
    return expand_lists(df, [(column, k, names)], group, delim, pad)


def expand_item_lists(df: DataFrame, group: Sequence[str] = ("ds",), **kw) -> DataFrame:
    """Both expansion steps of the cleaning stage in one pass: ``feature`` ->
    ``feature1..feature6``, the pair columns -> ``<c>_1``, ``<c>_2``."""
    specs = [("feature", FEATURE_K, FEATURE_NAMES)] + [
        (c, PAIR_K, [f"{c}_{i + 1}" for i in range(PAIR_K)]) for c in PAIR_COLUMNS]
    return expand_lists(df, specs, group, **kw)


def split_length_histogram(df: DataFrame, column: str, delim: str = DELIMITER,
                           group: Sequence[str] = ()) -> DataFrame:
    """(group..., n_tokens, rows) for non-null lists, one bin per length."""
    arr = split_tokens(column, delim)
    return (df.where(arr.isNotNull())
              .groupBy(*[col(g) for g in group], F.size(arr).alias("n_tokens"))
              .agg(F.count(F.lit(1)).alias("rows")))


def split_length_stats(df: DataFrame, column: str, delim: str = DELIMITER,
                       group: Sequence[str] = ()) -> DataFrame:
    """Longest list, and the most common length (ties: the shorter), with its
    row count.  Built on the histogram, which has one row per length."""
    h = split_length_histogram(df, column, delim, group)
    w = Window.partitionBy(*[col(g) for g in group])
    ordered = Window.partitionBy(*[col(g) for g in group]).orderBy(F.desc("rows"), F.asc("n_tokens"))
    return (h.withColumn("max_tokens", F.max("n_tokens").over(w))
             .withColumn("__r", F.row_number().over(ordered))
             .where(F.col("__r") == 1)
             .select(*[col(g) for g in group], "max_tokens",
                     F.col("n_tokens").alias("mode_tokens"), F.col("rows").alias("mode_rows")))
