"""URL filters: a Bloom filter cascade over the corpus's complete key universe.

Listed keys are the rules (``host/path``). A url's keys are its host suffixes, each with
the path prefixes whose lengths occur among the rules. Level 1 encodes the listed keys;
level 2 the keys of the universe that level 1 passes wrongly; level 3 the listed keys that
level 2 passes wrongly, and so on until a level passes nothing wrongly. A key of the
universe is then listed exactly if the first level that rejects it is an even one, so the
rows are judged by hashing alone, without a join.

DataFrame functions only. A level reaches the driver as set bit positions; with the level
sizes used here all levels together take about 1.44 * n * log2(universe / n) bits for n
listed keys, so what is sent depends on the rule list, not on the corpus rows.

Defined results: a null url, or one without ``://``, has empty host and path and no rule;
repeated rows are judged each; an empty rule list gives every row the default verdict;
further columns of the input are ignored.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import checkpoint

#: The rules of the registered query and their verdicts.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASHES = 4
#: A listed set whose filters would need more bits than this is refused, not cut.
MAX_BITS = 1 << 25
WORD = 32


@dataclass(frozen=True)
class Level:
    bits: int
    seed: int
    words: dict[int, int]  # word index -> 32 bits; absent words are 0


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path."""
    rest = F.when(F.instr(F.col(url), "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)"))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.translate(str.maketrans(UPPER, LOWER)), slash + path


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys of a url, longest first: host suffixes with path prefixes of these lengths."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    one = [F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in sorted(lengths, reverse=True)]
    keys = F.flatten(F.transform(suffixes, lambda s: F.array(*[F.concat(s, p) for p in one])))
    return F.when(host != "", F.filter(keys, lambda k: k.isNotNull())).otherwise(F.array().cast("array<string>"))


def _positions(key: Column, level_bits: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed * 16 + i), key), F.lit(level_bits)) for i in range(HASHES)]


def _build(keys: DataFrame, n: int, fpr: float, seed: int) -> Level:
    """Encodes the distinct keys; collects only the filter's non-zero words."""
    bits = max(64, math.ceil(-n * math.log(fpr) / math.log(2) ** 2 * 1.3))
    if bits > MAX_BITS:
        raise ValueError(f"a level needs {bits} bits, the bound is {MAX_BITS}")
    at = F.explode(F.array(*_positions(F.col("key"), bits, seed)))
    words = (keys.select(at.alias("at"))
             .groupBy((F.col("at") / WORD).cast("int").alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % WORD).cast("int"))).alias("set")))
    return Level(bits, seed, {r["word"]: r["set"] for r in words.collect()})


def passes(key: Column, level: Level) -> Column:
    """Whether a level's filter has the key."""
    n_words = (level.bits + WORD - 1) // WORD
    packed = b"".join((level.words.get(i, 0) & 0xFFFFFFFF).to_bytes(4, "big") for i in range(n_words))
    filter_hex = F.lit(packed)

    def bit(at: Column) -> Column:
        # byte 4 * (at / 32) + 3 - (at % 32) / 8 of the packed words
        byte = (at / WORD).cast("int") * 4 + 3 - ((at % WORD) / 8).cast("int")
        value = F.conv(F.hex(F.substring(filter_hex, byte + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(value, (at % 8).cast("int")) == 1

    test = None
    for at in _positions(key, level.bits, level.seed):
        test = bit(at) if test is None else test & bit(at)
    return test


def build_cascade(listed: DataFrame, universe: DataFrame, max_levels: int = 64) -> list[Level]:
    """Levels over a listed set and a universe, both with one column ``key``, distinct."""
    n_listed, n_all = listed.count(), universe.count()
    if not n_listed:
        return []
    levels: list[Level] = []
    inside, outside = listed, universe.join(F.broadcast(listed) if n_listed <= 100_000 else listed, "key", "left_anti")
    ratio = max(2.0, n_all / n_listed)
    n, fpr = n_listed, 1 / (ratio * math.sqrt(2))
    for seed in range(max_levels):
        level = _build(inside, n, fpr, seed)
        levels.append(level)
        wrong = checkpoint(outside.filter(passes(F.col("key"), level)))
        n, fpr = wrong.count(), 0.5
        if not n:
            return levels
        inside, outside = wrong, inside
    raise ValueError(f"no exact cascade within {max_levels} levels")


def member(key: Column, levels: list[Level]) -> Column:
    """Exact membership for keys of the universe the levels were built over."""
    if not levels:
        return F.lit(False)
    deepest = F.lit(len(levels) % 2 == 1)  # passed by every level
    for i in range(len(levels) - 1, -1, -1):
        deepest = F.when(passes(key, levels[i]), deepest).otherwise(F.lit(i % 2 == 1))
    return deepest


def filter_urls(pages: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every row; the longest fitting rule wins.

    ``default`` is the verdict of urls that no rule fits."""
    spark = pages.sparkSession
    parts = with_parts(pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url")))
    verdicts = {h + p: (r, v) for r, v in rules.items() for h, p in [split_rule(r)]}
    lengths = sorted({len(split_rule(r)[1]) for r in rules})
    if not rules:
        return parts.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
                            F.lit(default).alias("verdict"))
    keyed = parts.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), lengths))
    listed = spark.createDataFrame([(k,) for k in verdicts], "key string")
    universe = checkpoint(keyed.select(F.explode("keys").alias("key")).distinct())
    levels = build_cascade(listed, universe)
    hits = F.filter("keys", lambda k: member(k, levels))
    best = F.array_max(F.transform(hits, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))["key"]
    names = F.create_map(*[F.lit(x) for k, (r, _) in verdicts.items() for x in (k, r)])
    says = F.create_map(*[F.lit(x) for k, (_, v) in verdicts.items() for x in (k, v)])
    return (keyed.withColumn("best", best)
            .select("page_id", "host", "path", names[F.col("best")].alias("rule"),
                    F.coalesce(says[F.col("best")], F.lit(default)).alias("verdict")))
