"""Personal data: candidate spans selected by gradient-boosted trees.

Four strict kinds (email, ip, card, phone) are found by their patterns and always kept.
Generators with high recall propose further, overlapping spans: long opaque tokens, digit
groups, and anything around an ``@``. Boosted trees score them from format and context.
Their training rows are all candidates of the corpus: a token counts as personal if it
stands behind an assignment to a credential word, a number or address if it overlaps a
strict span; the features do not contain what decides the label. Features are small
integers, so the rows collapse to a table of at most a few thousand cells, one aggregation,
which the driver fits. Scores are calibrated on the same cells (isotonic), and the
candidates over a precision threshold that overlap no strict span are added.

DataFrame functions only: one projection without a shuffle for the result, one more pass
with an aggregation for the training cells.

Offsets count code points. Patterns with repeated groups are rewritten as single character
runs over a text in which separators between two fitting characters are replaced one for
one, so that matching costs linear time and no deep recursion. Positions, and the pieces of a
redacted text, are put together in blocks of the square root of their number, and overlaps are
found by search in the ordered spans, so a text of many matches costs little more than linear
time: ``n`` matches copy about ``n ** 1.5`` positions.

Defined results: null text is empty and has no spans; repeated rows are judged each; an
empty table gives no rows; further columns are ignored (``find_spans``) or kept (``redact``).
"""
from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import fenced

#: Private-use characters: span mark and stand-ins. Those found in a text become "~" first;
#: "~" belongs to no pattern.
MARK, SEP, DOT = "\ue000", "\ue001", "\ue002"
#: Kinds in the order of the listed spans; the first four are the strict ones.
KINDS = ("email", "ip", "card", "phone", "secret", "number", "address")
STRICT, PROPOSED = KINDS[:4], KINDS[4:]

SPACE = r"\x20\x09-\x0D"
#: kind -> (what has to be in the text, replacement before matching, pattern)
PATTERNS = {
    "email": ("@", (r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT),
              rf"(?:(?<![A-Za-z0-9._%+{DOT}-])|\G)[A-Za-z0-9._%+{DOT}-]++@[A-Za-z0-9-]++{DOT}[A-Za-z0-9{DOT}-]*+"),
    "ip": (r"[0-9]\.[0-9]", None, r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": (r"(?:[0-9][ -]?){15}[0-9]", (r"(?<=[0-9])[ -](?=[0-9])", SEP), rf"[0-9][0-9{SEP}]++"),
    "phone": ("+", None, r"\+[0-9][\x20().0-9-]+[0-9]"),
    "secret": (r"[A-Za-z0-9+/_-]{16}", None, r"[A-Za-z0-9+/_-]{16,}+=*+"),
    "number": (r"[0-9].?[0-9].?[0-9].?[0-9].?[0-9].?[0-9]", (r"(?<=[0-9])[ ./()-](?=[0-9])", SEP), rf"[0-9][0-9{SEP}]{{5,}}+"),
    "address": ("@", None, rf"[^{SPACE}@]{{1,64}}@[^{SPACE}@]{{1,255}}+"),
}
CUE = r"(?i)(?:token|key|secret|passw(?:or)?d|pwd|auth|bearer|credential)s?[\x20\"']*[=:][\x20\"']*$"
CONTACT = r"(?i)(?:card|account|acct|iban|ssn|phone|tel|fax|mobile|e-?mail|contact|call|id|no)\W*$"
FEATURES = ("kind", "digits", "letters", "hex", "mixed", "parts", "glued", "quoted", "contact")


# ------------------------------------------------------------------ spans

def _let(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once, however often the function uses it."""
    return F.transform(F.array(value), lambda v: fn(v))[0]


def _root(n: Column) -> Column:
    """Length of the blocks an array of n is handled in: its square root, so that lists which grow
    by copying stay that short."""
    return F.greatest(F.lit(64), F.ceil(F.sqrt(n)).cast("int"))


def _blocks(items: Column) -> Column:
    """An array cut into blocks."""
    size = _root(F.size(items))
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), size),
                       lambda at: F.slice(items, at + 1, size))


def _running(lengths: Column) -> Column:
    """Sums of the first 0, 1, ... of the lengths."""
    start = F.array(F.lit(0))

    def sums(block):
        return F.aggregate(block, start, lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))

    def joined(parts):
        """Blocks of sums from 0, each moved behind the ones before."""
        moved = _let(F.aggregate(parts, start, lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + F.element_at(p, -1)))),
                     lambda begin: F.transform(parts, lambda p, k: F.transform(
                         F.slice(p, 1, F.size(p) - 1), lambda n: n + F.get(begin, k))))
        return F.flatten(moved)

    return _let(F.transform(_blocks(lengths), sums), joined)


def _spans(text: Column, kind: str) -> Column:
    """array<struct<start, stop, body, before, after>> of a kind's matches."""
    needs, swap, pattern = PATTERNS[kind]
    there = F.contains(text, F.lit(needs)) if needs in "@+" else F.rlike(text, F.lit(needs))
    ready = F.regexp_replace(text, F.lit(swap[0]), F.lit(swap[1])) if swap else text
    split = F.split(F.regexp_replace(ready, F.lit(pattern), F.lit(f"{MARK}$0{MARK}")), MARK, -1)
    empty = F.array().cast("array<struct<start:int,stop:int,body:string,before:string,after:string>>")

    def span(start, body, before, behind):
        return F.struct(start.alias("start"), (start + F.length(body)).alias("stop"), body.alias("body"),
                        F.right(before, F.lit(32)).alias("before"), F.left(behind, F.lit(1)).alias("after"))

    def many(pieces):
        return _let(_running(F.transform(pieces, lambda p: F.length(p))), lambda at: F.transform(
            F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2)),
            lambda i: span(F.get(at, i), F.get(pieces, i), F.get(pieces, i - 1), F.get(pieces, i + 1))))

    def few(pieces):
        """One pass that copies the list for each match, which short lists bear."""
        start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

        def step(acc, i):
            begin = acc["at"] + F.length(F.get(pieces, i - 1))
            one = span(begin, F.get(pieces, i), F.get(pieces, i - 1), F.get(pieces, i + 1))
            return F.struct((begin + F.length(F.get(pieces, i))).alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2)), start, step, lambda acc: acc["out"])

    def found(pieces):
        """Odd pieces are matches."""
        return F.when(F.size(pieces) < 3, empty).when(F.size(pieces) < 100, few(pieces)).otherwise(many(pieces))

    return F.when(there, _let(split, found)).otherwise(empty)


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, F.lit("[^0-9]"), F.lit(""))


def _valid(kind: str, s: Column) -> Column:
    body = s["body"]
    n = F.length(_digits(body))
    if kind == "card":
        return n.between(16, 19) & F.call_function("luhn_check", _digits(body))
    if kind == "phone":
        return n.between(8, 15)
    if kind == "ip":
        parts = F.transform(F.split(body, r"\."), lambda p: F.regexp_replace(p, F.lit("^0+"), F.lit("")))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    return F.lit(True)


def _with_spans(docs: DataFrame, text_col: str, kinds: tuple[str, ...]) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    safe = F.when(F.rlike(text, F.lit(f"[{MARK}-{DOT}]")),
                  F.regexp_replace(text, F.lit(f"[{MARK}-{DOT}]"), F.lit("~"))).otherwise(text)
    out, spans = docs.withColumn("__text", fenced(safe)), {}
    for kind in kinds:
        spans[f"__{kind}"] = fenced(F.filter(_spans(F.col("__text"), kind), _of(_valid, kind)))
    return out.withColumns(spans)


def _of(fn, *args):
    """A one-argument function for Spark's array functions, which count a lambda's arguments."""
    return lambda s: fn(*args, s)


#: Steps of a search in an array, which has at most 2**31 - 1 elements.
_STEPS = [1 << k for k in range(30, -1, -1)]


def _meets(kind: str, s: Column) -> Column:
    """Whether a span overlaps one of a kind, whose spans are in order and apart from each other:
    the last that begins before the span's end has to end behind its start."""
    spans = F.col(f"__{kind}")

    def search():
        """How many begin before the span's end."""
        def step(n, k):
            return F.when((n + k <= F.size(spans)) & (F.get(spans, n + k - 1)["start"] < s["stop"]), n + k).otherwise(n)
        # a long first step would pass the largest int
        return F.aggregate(F.filter(F.array(*map(F.lit, _STEPS)), lambda k: k <= F.size(spans)), F.lit(0), step)

    few = F.exists(spans, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
    many = _let(search(), lambda n: (n > 0) & (F.get(spans, n - 1)["stop"] > s["start"]))
    return F.when(F.size(spans) <= 16, few).otherwise(F.coalesce(many, F.lit(False)))


def _overlaps(s: Column) -> Column:
    """Whether a span overlaps a strict one."""
    hit = _meets(STRICT[0], s)
    for kind in STRICT[1:]:
        hit = hit | _meets(kind, s)
    return hit


# ------------------------------------------------------------------ features and trees

def _bin(value: Column, edges: tuple[int, ...]) -> Column:
    out = F.lit(0)
    for k, edge in enumerate(edges, 1):
        out = F.when(value >= edge, k).otherwise(out)
    return out


def _features(kind: str, s: Column) -> Column:
    body, before = s["body"], s["before"]
    flag = lambda c: F.coalesce(c.cast("int"), F.lit(0))
    has = lambda p: flag(F.rlike(body, F.lit(p)))
    letters = F.length(F.regexp_replace(body, F.lit("[^A-Za-z]"), F.lit("")))
    parts = F.length(F.regexp_replace(body, F.lit(f"[^{SEP}._@/+-]"), F.lit("")))
    return F.struct(
        F.lit(PROPOSED.index(kind)).alias("kind"),
        _bin(F.length(_digits(body)), (1, 7, 10, 13, 16, 20)).alias("digits"),
        _bin(letters, (1, 6, 16, 32)).alias("letters"),
        has(r"^[0-9a-f]+$").alias("hex"),
        (has("[a-z]") + has("[A-Z]") + has("[0-9]")).alias("mixed"),
        _bin(parts, (1, 2, 3, 5)).alias("parts"),
        flag(F.rlike(before, F.lit(r"[A-Za-z0-9]$"))).alias("glued"),
        flag(F.rlike(s["after"], F.lit("[\"']"))).alias("quoted"),
        flag(F.rlike(before, F.lit(CONTACT))).alias("contact"))


def _label(kind: str, s: Column) -> Column:
    if kind == "secret":
        return F.coalesce(F.rlike(s["before"], F.lit(CUE)), F.lit(False)) | _overlaps(s)
    return _overlaps(s)


def _example(kind: str, s: Column) -> Column:
    return F.struct(_features(kind, s).alias("f"), _label(kind, s).cast("int").alias("y"))


def training_cells(docs: DataFrame, text_col: str = "text") -> list[tuple[tuple[int, ...], int, int]]:
    """(features, candidates, personal ones) over all candidates of the corpus."""
    spans = _with_spans(docs.select(F.col(text_col)), text_col, KINDS)
    rows = F.concat(*[F.transform(F.col(f"__{k}"), _of(_example, k)) for k in PROPOSED])
    cells = (spans.select(F.explode(rows).alias("r")).groupBy("r.f")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("r.y").alias("pos")).collect())
    return sorted((tuple(r["f"]), r["n"], r["pos"]) for r in cells)


@dataclass
class Trees:
    """Boosted trees over small integers: nested (feature, edge, below, from) or leaf values."""

    base: float = 0.0
    trees: list = field(default_factory=list)
    threshold: float = math.inf

    def score(self, f: tuple[int, ...]) -> float:
        total = self.base
        for tree in self.trees:
            while isinstance(tree, tuple):
                tree = tree[2] if f[tree[0]] < tree[1] else tree[3]
            total += tree
        return total

    def column(self, f: Column) -> Column:
        def one(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            return F.when(f[FEATURES[tree[0]]] < tree[1], one(tree[2])).otherwise(one(tree[3]))
        total = F.lit(self.base)
        for tree in self.trees:
            total = total + one(tree)
        return total


def fit_trees(cells: list[tuple[tuple[int, ...], int, int]], rounds: int = 25, depth: int = 3, rate: float = 0.4,
              ridge: float = 1.0, precision: float = 0.9) -> Trees:
    """Newton boosting of the logistic loss, then a threshold with this calibrated precision."""
    n, pos = sum(c[1] for c in cells), sum(c[2] for c in cells)
    model = Trees()
    if not 0 < pos < n:
        return model
    model.base = math.log(pos / (n - pos))
    scores = [model.base] * len(cells)

    def grow(rows: list[int], level: int, g: list[float], h: list[float]):
        gs, hs = sum(g[i] for i in rows), sum(h[i] for i in rows)
        best, cut = gs * gs / (hs + ridge) + 1e-6, None
        if level < depth and len(rows) > 1:
            for k in range(len(FEATURES)):
                by: dict[int, list[float]] = {}
                for i in rows:
                    at = by.setdefault(cells[i][0][k], [0.0, 0.0])
                    at[0] += g[i]
                    at[1] += h[i]
                lg = lh = 0.0
                edges = sorted(by)
                for value, edge in zip(edges, edges[1:], strict=False):
                    lg, lh = lg + by[value][0], lh + by[value][1]
                    gain = lg * lg / (lh + ridge) + (gs - lg) ** 2 / (hs - lh + ridge)
                    if gain > best:
                        best, cut = gain, (k, edge)
        if cut is None:
            return -rate * gs / (hs + ridge)
        k, edge = cut
        return (k, edge, grow([i for i in rows if cells[i][0][k] < edge], level + 1, g, h),
                grow([i for i in rows if cells[i][0][k] >= edge], level + 1, g, h))

    for _ in range(rounds):
        p = [1 / (1 + math.exp(-max(-30.0, min(30.0, s)))) for s in scores]
        g = [c[1] * q - c[2] for c, q in zip(cells, p, strict=True)]
        h = [c[1] * q * (1 - q) for c, q in zip(cells, p, strict=True)]
        tree = grow(list(range(len(cells))), 0, g, h)
        model.trees.append(tree)
        only = Trees(0.0, [tree])
        scores = [s + only.score(c[0]) for s, c in zip(scores, cells, strict=True)]

    # isotonic calibration over score order; the lowest block that is precise enough begins the selection
    blocks: list[list[float]] = []
    for s, (_, m, y) in sorted(zip(scores, cells, strict=True), key=lambda x: x[0]):
        blocks.append([s, m, y])
        while len(blocks) > 1 and (blocks[-2][0] == blocks[-1][0] or blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]):
            _, m2, y2 = blocks.pop()
            blocks[-1][1] += m2
            blocks[-1][2] += y2
    model.threshold = next((b[0] - 1e-9 for b in blocks if b[2] >= precision * b[1]), math.inf)
    return model


# ------------------------------------------------------------------ the operator

def fit(docs: DataFrame, text_col: str = "text") -> Trees:
    return fit_trees(training_cells(docs, text_col))


def _chosen(model: Trees, kind: str, s: Column) -> Column:
    ok = (model.column(_features(kind, s)) >= model.threshold) & ~_overlaps(s)
    for earlier in PROPOSED[: PROPOSED.index(kind)]:
        ok = ok & ~_meets(earlier, s)
    return ok


def _all_spans(docs: DataFrame, text_col: str, model: Trees) -> DataFrame:
    """Adds __<kind> arrays; proposed kinds hold the selected spans only."""
    kinds = KINDS if model.trees and model.threshold < math.inf else STRICT
    out = _with_spans(docs, text_col, kinds)
    for kind in PROPOSED:
        if kind not in kinds:
            out = out.withColumn(f"__{kind}", F.filter(F.col("__email"), lambda s: F.lit(False)))
            continue
        out = out.withColumn(f"__{kind}", fenced(F.filter(F.col(f"__{kind}"), _of(_chosen, model, kind))))
    return out


def _named(kind: str, s: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["stop"].cast("string"))


def _listed(kinds: tuple[str, ...]) -> Column:
    return F.array_join(F.concat(*[F.transform(F.col(f"__{k}"), _of(_named, k)) for k in kinds]), ",")


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Trees | None = None) -> DataFrame:
    """doc_id, counts of the strict kinds, base_sha256 of their spans, and all spans as text."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    spans = _all_spans(rows, "text", model or fit(rows))
    return spans.select(
        "doc_id", *[F.size(f"__{k}").cast("bigint").alias(f"n_{k}") for k in STRICT],
        F.sha2(_listed(STRICT).cast("binary"), 256).alias("base_sha256"), _listed(KINDS).alias("spans"))


def _replacement(kind: str, s: Column) -> Column:
    return F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.lit(f"[{kind.upper()}]").alias("name"))


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", model: Trees | None = None) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; overlapping spans
    become one, named by the first. ``chars_col``, if there, counts the new text."""
    names = docs.columns
    spans = _all_spans(docs, text_col, model or fit(docs, text_col))
    each = F.array_sort(F.concat(*[F.transform(F.col(f"__{k}"), _of(_replacement, k)) for k in KINDS]))
    text = F.col(text_col)

    def rest_of(block, begin):
        """The text from ``begin`` to the end of the block's last new span, with its spans replaced.
        Substrings are taken of the block's own text, whose characters are few to count."""
        stop = F.greatest(begin, F.array_max(F.transform(block, lambda s: s["stop"])))
        none = F.array().cast("array<string>")
        start = F.struct(begin.alias("at"), none.alias("out"))

        def cut_up(own):
            def step(acc, s):
                new = s["start"] >= acc["at"]
                gap = F.substring(own, acc["at"] - begin + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
                return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"),
                                F.when(new, F.concat(acc["out"], F.array(gap, s["name"]))).otherwise(acc["out"]).alias("out"))
            return F.array_join(F.aggregate(block, start, step, lambda acc: acc["out"]), "")

        return _let(F.substring(text, begin + 1, stop - begin), cut_up)

    def joined(blocks):
        # where each block's text begins: behind the furthest end of the spans before it
        ends = F.transform(blocks, lambda b: F.array_max(F.transform(b, lambda s: s["stop"])))
        begins = F.aggregate(ends, F.array(F.lit(0)), lambda acc, e: F.concat(
            acc, F.array(F.greatest(F.element_at(acc, -1), e))))
        return _let(begins, lambda at: F.concat(
            F.array_join(F.transform(blocks, lambda b, k: rest_of(b, F.get(at, k))), ""),
            F.substring(text, F.element_at(at, -1) + 1, F.length(text))))

    out = spans.withColumn("__each", fenced(each))
    clean = F.when(F.size("__each") > 0, _let(_blocks(F.col("__each")), joined)).otherwise(text)
    columns = []
    for name in names:
        if name == text_col:
            columns.append(F.col("__clean").alias(name))
        elif name == chars_col:
            columns.append(F.when(F.size("__each") > 0, F.length("__clean")).otherwise(F.col(name))
                           .cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(F.col(f"`{name}`"))
    return out.withColumn("__clean", fenced(clean)).select(*columns)
