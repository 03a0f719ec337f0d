"""URL filter: rules by host and path, and gradient-boosted trees on lexical features for all other addresses.

DataFrame operations only. Features of an address: its length and its host's, the depth of its path, the share of digits, the entropy of its characters, the
number of parameters, and of its host's last label and last two labels how many labelled addresses end so and which share of them is blocked.

The labelled addresses are dealt in two halves by a hash. One half, whole, gives the statistics of suffixes; so no tree sees an address's own label in them. Of the other,
a sample by hash of at most about ``most_rows`` different addresses grows the trees: features are cut into bins at exact quantiles, and
each level of a tree needs one aggregation, by node, feature and bin, of the gradients of the logistic loss. Gradients are summed as whole numbers, so that the model
does not depend on how rows are dealt to tasks. The driver holds one row per node, feature and bin.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import release, settle

ALLOW, BLOCK = "allow", "block"
FEATURES = ["f_length", "f_host", "f_depth", "f_digits", "f_entropy", "f_params", "f_last", "f_last_seen", "f_two", "f_two_seen"]
#: Weight of the common share in a suffix's own.
SMOOTHING = 4.0
#: Gradients are whole multiples of 1 / UNIT.
UNIT = 1 << 24
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case. Path: then up to ``?``, ``#`` or the end. Both empty without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.char_length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


@dataclass(frozen=True)
class Rule:
    """A verdict for a host and its subdomains, if the path begins with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def matching_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null; of equally long ones the first. For a few rules, which become one expression."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):  # the last one that is put around the others is asked first
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def _suffixes(host: Column) -> tuple[Column, Column]:
    """Keys of a host's last label and of its last two."""
    return F.concat(F.lit("1:"), F.substring_index(host, ".", -1)), F.concat(F.lit("2:"), F.substring_index(host, ".", -2))


def _plain_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    n = F.char_length(url)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    counts = F.transform(F.array_distinct(F.split(url, "")), lambda c: F.when(c == "", 0).otherwise((n - F.char_length(F.replace(url, c, F.lit("")))).cast("double")))
    heavy = F.aggregate(counts, F.lit(0.0), lambda a, c: a + F.when(c > 0, c * F.log2(c)).otherwise(0.0))
    return {
        "f_length": n.cast("double"),
        "f_host": F.char_length(host).cast("double"),
        "f_depth": (F.char_length(path) - F.char_length(F.replace(path, F.lit("/"), F.lit("")))).cast("double"),
        "f_digits": F.when(n > 0, (n - F.char_length(F.translate(url, "0123456789", ""))) / n).otherwise(0.0),
        # Rounded, so that the order of summation makes no difference.
        "f_entropy": F.when(n > 0, F.round(F.log2(n.cast("double")) - heavy / n, 6)).otherwise(0.0),
        "f_params": F.when(query == "", 0.0).otherwise((1 + F.char_length(query) - F.char_length(F.replace(query, F.lit("&"), F.lit("")))).cast("double")),
    }


@dataclass(frozen=True)
class UrlModel:
    """Trees as nested lists (feature, bound, left, right) over leaf values; ``suffixes``: suffix, share, seen."""

    base: float
    prior: float
    trees: list
    suffixes: DataFrame


def _with_features(rows: DataFrame, suffixes: DataFrame, prior: float) -> DataFrame:
    """``rows`` (url, host, path and others) with FEATURES. A suffix that the statistics lack has the common share."""
    one, two = _suffixes(F.col("host"))
    out = rows.withColumns({"__one": one, "__two": two})
    for key, name in (("__one", "f_last"), ("__two", "f_two")):
        # Rows may lie on one suffix for the greater part; they are the side of the join that can be split, and are not moved at all while the statistics are small.
        out = out.join(suffixes.select(F.col("suffix").alias(key), F.col("share").alias(name), F.col("seen").alias(f"{name}_seen")), key, "left")
        out = out.withColumns({name: F.coalesce(name, F.lit(prior)), f"{name}_seen": F.coalesce(f"{name}_seen", F.lit(0.0))})
    return out.drop("__one", "__two").withColumns(_plain_features(F.col("url"), F.col("host"), F.col("path")))


def _sql(tree) -> str:
    if isinstance(tree, float):
        return f"{tree!r}D"
    feature, bound, left, right = tree
    return f"CASE WHEN {feature} > {bound!r}D THEN {_sql(right)} ELSE {_sql(left)} END"


def _node(tree, path: str = "1") -> str:
    """Number of the leaf that a row is in, as SQL; the root is 1, and below node k are 2 k and 2 k + 1."""
    if isinstance(tree, float) or tree is None:
        return str(int(path, 2))
    feature, bound, left, right = tree
    return f"CASE WHEN {feature} > {bound!r}D THEN {_node(right, path + '1')} ELSE {_node(left, path + '0')} END"


def _margin(base: float, trees: Sequence) -> Column:
    return F.expr(" + ".join([f"{base!r}D", *[f"({_sql(t)})" for t in trees]]))


def _probability(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def _grow(rows: DataFrame, edges: dict[str, list[float]], depth: int, rate: float, ridge: float, least_rows: int):
    """One tree. ``rows``: FEATURES, bins (array), grad, hess (whole numbers). One job per level."""
    tree = None
    leaves: dict[int, tuple[int, int]] = {}

    def put(now, node: int, new):
        """The tree with ``new`` at ``node``."""
        if node == 1:
            return new
        path = bin(node)[3:]
        feature, bound, left, right = now
        rest = int("1" + path[1:], 2)
        return (feature, bound, left, put(right, rest, new)) if path[0] == "1" else (feature, bound, put(left, rest, new), right)

    active = [1]
    for level in range(depth):
        placed = rows.withColumn("node", F.expr(_node(tree))).where(F.col("node").isin(active))
        bins = placed.select("node", "grad", "hess", F.posexplode("bins").alias("f", "bin"))
        found = bins.groupBy("node", "f", "bin").agg(F.sum("grad").alias("g"), F.sum("hess").alias("h"), F.count(F.lit(1)).alias("n")).collect()
        sums: dict[int, dict[int, dict[int, tuple[int, int, int]]]] = {}
        for r in found:
            sums.setdefault(r["node"], {}).setdefault(r["f"], {})[r["bin"]] = (r["g"], r["h"], r["n"])
        going = []
        for node in active:
            if node not in sums:
                continue
            by_bin = next(iter(sums[node].values()))
            G, H, N = (sum(v[i] for v in by_bin.values()) for i in range(3))
            leaves[node] = (G, H)
            best = None
            for f, name in enumerate(FEATURES):
                g = h = n = 0
                for at, bound in enumerate(edges[name]):
                    dg, dh, dn = sums[node][f].get(at, (0, 0, 0))
                    g, h, n = g + dg, h + dh, n + dn
                    if n < least_rows or N - n < least_rows:
                        continue
                    gain = g * g / (h + ridge) + (G - g) ** 2 / (H - h + ridge) - G * G / (H + ridge)
                    if gain > 1e-6 * UNIT and (best is None or gain > best[0]):
                        best = (gain, name, bound, (g, h), (G - g, H - h))
            if best is not None:
                tree = put(tree, node, (best[1], best[2], None, None))
                leaves[2 * node], leaves[2 * node + 1] = best[3], best[4]
                going += [2 * node, 2 * node + 1]
        active = going
        if not active:
            break

    def filled(now, node: int):
        if now is None:
            g, h = leaves.get(node, (0, 0))
            return rate * g / (h + ridge)
        feature, bound, left, right = now
        return (feature, bound, filled(left, 2 * node), filled(right, 2 * node + 1))

    return filled(tree, 1)


def _bin(feature: str, edges: list[float]) -> Column:
    return F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < F.col(feature)))


def train(labelled: DataFrame, url_col: str = "url", block_col: str = "block", most_rows: int = 50_000, trees: int = 10, depth: int = 3, bins: int = 16,
          rate: float = 0.4, least_rows: int = 5) -> UrlModel:
    """A model from addresses that are labelled (true: blocked). Rows without a label are left out; a null address is an empty one.

    Statistics cover half of all rows, the trees a sample by hash of at most about ``most_rows`` different rows of the other half. Without rows, or with one label only, every address
    gets about that one's score, or 0 if there is none.
    """
    rows = labelled.select(F.coalesce(F.col(f"`{url_col}`"), F.lit("")).alias("url"), F.col(f"`{block_col}`").alias("block")).where("block IS NOT NULL")
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path, "h": F.xxhash64("url")})
    totals = rows.agg(F.count(F.lit(1)), F.count_if("block"), F.count_if(F.col("h") % 2 != 0)).first()
    n, blocks, fitted = (int(x) for x in totals)
    prior = blocks / n if n else 0.0
    half = rows.where(F.col("h") % 2 == 0)
    counts = half.select(F.explode(F.array(*_suffixes(F.col("host")))).alias("suffix"), "block").groupBy("suffix").agg(F.count(F.lit(1)).alias("n"), F.count_if("block").alias("b"))
    suffixes = settle(counts.select("suffix", ((F.col("b") + SMOOTHING * prior) / (F.col("n") + SMOOTHING)).alias("share"), F.round(F.log2(1.0 + F.col("n")), 6).alias("seen")), "suffixes")
    base = math.log((blocks + 0.5) / (n - blocks + 0.5)) if n else -1e3
    if not (0 < blocks < n and fitted):
        return UrlModel(base, prior, [], suffixes)
    # By the hash alone: copies of an address are all in the sample or all out of it, and count once.
    bound = min(1.0, most_rows / fitted)
    sample = rows.where((F.col("h") % 2 != 0) & (F.pmod(F.shiftright("h", 1), F.lit(1 << 30)) < int(bound * (1 << 30)))).select("url", "host", "path", "block").distinct()
    sample = settle(_with_features(sample, suffixes, prior).select("block", *FEATURES), "url-sample")
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    quantiles = sample.agg(*[F.percentile(F.col(f), shares).alias(f) for f in FEATURES]).first()
    if quantiles[0] is None:
        release(sample)
        return UrlModel(base, prior, [], suffixes)
    edges = {f: sorted(set(quantiles[f])) for f in FEATURES}
    coded = settle(sample.withColumn("bins", F.array(*[_bin(f, edges[f]) for f in FEATURES])), "url-bins")
    made: list = []
    for _ in range(trees):
        p = _probability(_margin(base, made))
        grad = F.round(((F.col("block").cast("double") - p) * UNIT)).cast("bigint")
        hess = F.round((p * (1.0 - p) * UNIT)).cast("bigint")
        tree = _grow(coded.withColumns({"grad": grad, "hess": hess}), edges, depth, rate, float(UNIT), least_rows)
        if isinstance(tree, float):
            break
        made.append(tree)
    release(sample, coded)
    return UrlModel(base, prior, made, suffixes)


def judge(pages: DataFrame, model: UrlModel, rules: Sequence[Rule] = (), id_col: str = "page_id", url_col: str = "url", most: float = 0.5) -> DataFrame:
    """id, host, path, rule, verdict, score of every row; other columns are not read.

    The verdict is that of the longest rule that fits, whose text is ``rule``; else the model's: block from a score of ``most`` up. A null address has an empty host and
    path, and the score of an empty one. Rows of equal or null id are judged each. An empty table gives no rows.
    """
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), url.alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = _with_features(rows.withColumns({"host": host, "path": path}), model.suffixes, model.prior)
    rule, verdict = matching_rule(rules, F.col("host"), F.col("path"))
    score = _probability(_margin(model.base, model.trees))
    return rows.select("id", "host", "path", rule.alias("rule"), score.alias("score"), verdict.alias("ruled")).select(
        "id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") >= most, BLOCK).otherwise(ALLOW)).alias("verdict"), "score")


def labelled_by_rules(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url") -> DataFrame:
    """url, block: the addresses that rules decide, as examples for ``train``."""
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    _, verdict = matching_rule(rules, *host_and_path(url))
    return pages.select(url.alias("url"), (verdict == BLOCK).alias("block")).where("block IS NOT NULL")
