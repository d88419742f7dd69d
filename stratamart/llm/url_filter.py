"""URL verdicts from a cascade of Bloom filters, in DataFrame functions only.

The keys of the whole corpus are known, so filters can be exact on them. Level 1 holds the listed keys.
Level 2 holds the keys that level 1 takes for listed though they are not, level 3 the listed keys that
level 2 takes for those, and so on until a level is never wrong. A key is listed if the number of levels
that it passes in a row is odd. Each level is a small fraction of the one before.

Filters are kept in shards by a hash of the key. A shard has about ``SHARD_KEYS`` keys of the corpus, so
its filters have a bounded size, whatever the corpus and the list hold. To judge a row, only the filters
of its shard are looked up; rows never meet the listed keys.

Defined results: a NULL url or one without ``://`` has an empty host and an empty path. Repeated rows give
repeated results. Only the id and the url are read. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import materialise

SHARD_KEYS = 50_000
#: Rows that ask one shard in one task; a shard with more is spread over several, fewer than MOST_HEAVY shards.
HEAVY_ROWS, MOST_HEAVY = 1_000_000, 10_000
#: 8 hashes and 11.6 bits a key: one of about 256 other keys passes.
HASHES = 8
BITS_PER_KEY = 11.6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_KEY = ["key1", "key2"]


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        """The host itself or a subdomain, and a path that starts with the rule's."""
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: str | Column) -> Column:
    column = F.col(url) if isinstance(url, str) else url
    return F.translate(F.coalesce(F.regexp_extract(column, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: str | Column) -> Column:
    column = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(column, _PARTS, 2), F.lit(""))


def winning_rule(rules: list[Rule], host: Column, path: Column, value) -> Column:
    """``value`` of the longest rule that fits, else NULL. Rules are a short list; long ones belong in a cascade."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        out = F.when(rule.fits(host, path), F.lit(value(rule))).otherwise(out)
    return out


def key_hashes(key: Column) -> list[Column]:
    """Two 64-bit hashes that together stand for a key."""
    return [F.xxhash64(F.lit(seed), key).alias(name) for seed, name in enumerate(_KEY, 1)]


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), *_KEY), F.lit(shards)).cast("int")


def _positions(level: int, words: int) -> list[Column]:
    """Bit numbers of a key in a filter of ``words`` 64-bit words."""
    return [F.pmod(F.xxhash64(F.lit(1000 * level + i), *_KEY), F.lit(words * 64)).cast("int") for i in range(HASHES)]


def _filter(keys: DataFrame, level: int, words: int, shards: int) -> DataFrame:
    """One row per shard: an array of words. Unset words come from a range, so that arrays are complete."""
    at = F.explode(F.array(*_positions(level, words))).alias("at")
    ones = keys.select("shard", at).select(
        "shard", F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, at & 63)").alias("bits")
    )
    zeros = keys.sparkSession.range(shards * words).select(
        F.expr(f"cast(id div {words} as int)").alias("shard"),
        F.expr(f"cast(id % {words} as int)").alias("word"),
        F.lit(0).cast("long").alias("bits"),
    )
    merged = ones.unionByName(zeros).groupBy("shard", "word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))  # at most ``words`` for each shard
    return merged.groupBy("shard").agg(F.transform(ordered, lambda x: x["bits"]).alias(f"level{level}"))


def _passes(level: int, words: int) -> Column:
    """Whether all bits of a key are set in the array of this level."""
    tests = [
        F.getbit(F.get(F.col(f"level{level}"), F.shiftright(at, 6)), at.bitwiseAND(63)) == 1
        for at in _positions(level, words)
    ]
    return reduce(Column.__and__, tests)


@dataclass
class Cascade:
    """``filters`` has a row per shard and an array per level; ``words`` the length of each array.

    ``heavy`` has the shards that more rows ask than a task should get, and over how many they are spread.
    """

    filters: DataFrame
    words: list[int]
    shards: int
    heavy: DataFrame

    def listed(self) -> Column:
        """Listed, for rows that are joined with their shard's filters: passes 1 and not (passes 2 and not ...)."""
        out = F.lit(False)
        for level in range(len(self.words), 0, -1):
            out = _passes(level, self.words[level - 1]) & ~out
        return out

    def mark(self, rows: DataFrame, key: Column, name: str = "listed") -> DataFrame:
        """``rows`` with a boolean column. Exact for every key of the universe the cascade was built on."""
        columns = rows.columns
        hashed = rows.select("*", F.xxhash64(*columns).alias("salt"), *key_hashes(key)).withColumn("shard", _shard(self.shards))
        heavy = F.broadcast(self.heavy)  # fewer than MOST_HEAVY rows
        tasks = F.coalesce("tasks", F.lit(1))
        salted = hashed.join(heavy, "shard", "left").withColumn("salt", F.pmod("salt", tasks).cast("int"))
        filters = self.filters.join(heavy, "shard", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), tasks - 1)))
        return salted.join(filters.drop("tasks"), ["shard", "salt"]).select(*columns, self.listed().alias(name))


def _heavy_shards(keys: DataFrame, heavy_rows: int) -> DataFrame:
    """(shard, tasks): shards with more rows than a task's share, as the keys count them."""
    asked = keys.groupBy("shard").agg(F.sum("rows").alias("n"))
    total = asked.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    share = max(heavy_rows, -(-int(total) // MOST_HEAVY))
    return materialise(
        asked.where(F.col("n") > share).select("shard", F.ceil(F.col("n") / share).cast("int").alias("tasks")), "url-heavy"
    )


def build_cascade(universe: DataFrame, shard_keys: int = SHARD_KEYS, heavy_rows: int = HEAVY_ROWS) -> Cascade:
    """From all keys of the corpus, hashed (key1, key2) and distinct, with the boolean column listed.

    A column ``rows`` tells how many rows ask for each key; without it each counts as one.
    """
    n = universe.count()
    if "rows" not in universe.columns:
        universe = universe.withColumn("rows", F.lit(1))
    shards = max(1, -(-n // shard_keys))
    keys = materialise(universe.select(*_KEY, "listed", "rows").withColumn("shard", _shard(shards)), "url-keys")
    heavy = _heavy_shards(keys, heavy_rows)
    keys = keys.drop("rows")
    inside, outside = keys.where("listed").drop("listed"), keys.where("not listed").drop("listed")
    levels, words, level = [], [], 0
    while n_inside := inside.count():
        level += 1
        words.append(max(1, -(-int(n_inside * BITS_PER_KEY / shards) // 64)))
        levels.append(materialise(_filter(inside, level, words[-1], shards), f"url-level-{level}"))
        wrong = outside.join(levels[-1], "shard").where(_passes(level, words[-1])).select("shard", *_KEY)
        inside, outside = materialise(wrong, f"url-wrong-{level}"), inside
    if not levels:
        return Cascade(keys.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")), [], shards, heavy)
    return Cascade(reduce(lambda a, b: a.join(b, "shard"), levels), words, shards, heavy)


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    id_column: str = "page_id",
    url_column: str = "url",
    shard_keys: int = SHARD_KEYS,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """page_id, host, path, the longest rule that fits, and the verdict.

    The list of the cascade is every host and path of the corpus that the rules block; keys outside it,
    also those that no rule fits, are allowed.
    """
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"), host_of(url_column).alias("host"), path_of(url_column).alias("path")
    )
    # A host holds no slash and a path starts with one, so the two together are a key.
    key, host, path = F.concat("host", "path"), F.col("host"), F.col("path")
    blocked = F.coalesce(winning_rule(rules, host, path, lambda r: r.action) == "block", F.lit(False))
    universe = rows.select(*key_hashes(key), blocked.alias("listed")).groupBy(*_KEY).agg(
        F.bool_or("listed").alias("listed"), F.count("*").alias("rows")
    )
    cascade = build_cascade(universe, shard_keys, heavy_rows)
    marked = cascade.mark(rows.withColumn("rule", winning_rule(rules, host, path, lambda r: r.text)), key)
    verdict = F.when(F.col("listed"), "block").otherwise("allow")
    return marked.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
