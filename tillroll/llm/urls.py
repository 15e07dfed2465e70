"""URL filter: allow and block rules first, then logistic regression on hashed character n-grams of host and path.

1. Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to ``?``,
   ``#`` or the end. A rule is a host and the start of a path; it fits its host and all subdomains. The longest one wins;
   of equally long ones that with the longer host.
2. The features are the n-grams (``SIZES`` characters) of the host and of the path, each with its ends marked and with
   digits made alike, hashed into 2 ** ``BITS`` places apart for host and path, counted once and scaled to length 1. The
   weights come from a small labelled table (url, label): batch gradient descent with momentum on the logistic loss, the
   two labels weighing the same, with an L2 penalty.
3. URLs without a rule are blocked if their probability reaches ``least``.

Judging is one pass without a shuffle, so no host is too frequent; the scores of recent hosts are kept in a cache of
bounded size. Defined results: a null url and one without ``://`` have an empty host and path, fit no rule, and are
allowed, since nothing speaks against them; very long urls are judged whole; repeated rows get the same verdict; labelled rows whose url is
null or whose label isn't ``allow`` or ``block`` teach nothing; where one label is missing, the other is the verdict, and
``allow`` where both are; an empty table gives an empty result; other columns are ignored.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows

ALLOW, BLOCK = "allow", "block"
BITS = 16
SIZES = (2, 3, 4, 5)
PIECE = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Names, prefixes, endings and paths of the labelled table that the query learns from. By turns, each name goes
#: with some prefixes, endings and paths, of which only the paths differ between the labels.
BLOCKED_NAMES = """best-casino online-casino24 casino-royal-bonus grand-win-slots win-big-slots jackpot-winner poker-free-chips
bet365-mirror bets-live sport-bets-now free-spins cheap-meds pills-online viagra-pills cheap-watches
cheap-replica-bags discount-pills-shop weight-loss-pills adult-video adult-chat-live hot-adult-cams xxx-movies
x-rated-clips sexy-dates spam-links spammy-blog-net link-farm content-farm-seo seo-farm-links ads-server
ad-track-pixel click-track-ads tracker-ads pop-ads-media free-gift-cards free-iphone-win free-download-crack
crack-keygen-warez loan-payday-fast crypto-double-win""".split()
ALLOWED_NAMES = """news city-library museum university physics-lab gardening weather recipes history-archive open-data python-guide
wiki-travel maps hospital school-board football-results theatre theory-notes author-notes other-thoughts
the-river-times northern-herald nation-today education-station thunder-rain thesis-editor translation stationery
method anthology rethink-health theorem tenth-street strathon inthering thousand-trees athletics-club brothers-bakery
action-nation notable-people""".split()
PREFIXES, ENDINGS = ["", "www.", "blog.", "m."], ["example.com", "example.org", "example.net"]
BLOCKED_PATHS = ["/", "/win/now", "/en/12", "/bonus/100", "/fr/30.html", "/buy/cheap/4", "/de/7/", "/go/7", "/es/451"]
ALLOWED_PATHS = ["/", "/about", "/en/12", "/news/today", "/fr/30.html", "/2019/05/story.html", "/de/7/", "/faq", "/es/451"]


def labelled_urls(variants: int = 3) -> list[tuple[str, str]]:
    """(url, label) of the small table that the registered query learns from: ``variants`` urls of each name."""
    sides = ((BLOCK, BLOCKED_NAMES, BLOCKED_PATHS), (ALLOW, ALLOWED_NAMES, ALLOWED_PATHS))
    return [
        (f"https://{PREFIXES[n % 4]}{name}.{ENDINGS[n % 3]}{paths[(n + n // 9) % len(paths)]}", label)
        for label, names, paths in sides
        for i, name in enumerate(names)
        for n in range(i, i + 5 * variants, 5)
    ]


def host_and_path(url: Column) -> tuple[Column, Column]:
    url, pattern = F.coalesce(url, F.lit("")), "://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER), F.regexp_extract(url, pattern, 2)


def rule_column(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The rule that decides and its verdict, both null where none fits. ``rules``: (allow or block, host and path)."""
    split = [(verdict, rule, *rule.partition("/")[::2]) for verdict, rule in rules]
    ranked = sorted(split, key=lambda r: (-len(r[1]), -len(r[2]), r[0]))
    which, what = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, rule, rule_host, rest in reversed(ranked):
        own = (host == rule_host) | host.endswith(f".{rule_host}")
        fits = own & path.startswith(f"/{rest}") if "/" in rule else own
        which, what = F.when(fits, F.lit(rule)).otherwise(which), F.when(fits, F.lit(verdict)).otherwise(what)
    return which, what


def places(text: str, salt: int) -> np.ndarray:
    """Where the n-grams of a text go, each place once."""
    found = [np.empty(0, np.int64)]
    width = max(SIZES)
    for at in range(0, len(text) + 2, PIECE):
        part = f"\x02{text}\x03"[max(0, at - width + 1) : at + PIECE]
        cp = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        cp = np.where((cp >= 48) & (cp <= 57), np.uint64(48), cp)
        code = np.full(len(cp), salt, np.uint64)
        for n in range(1, width + 1):
            code = (code[: len(cp) - n + 1] * np.uint64(0x100000001B3)) ^ cp[n - 1 :] if n <= len(cp) else code[:0]
            if n in SIZES:
                mixed = (code ^ (code >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
                found.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
        found = [np.unique(np.concatenate(found))]
    return found[0]


class Model:
    """Weights of the places and the bias; positive means block."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self._host = None

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "bias": self.bias, "_host": None}

    def part(self, text: str, salt: int) -> tuple[float, int]:
        at = places(text, salt)
        return float(self.weights[at].sum()), len(at)

    def probability(self, host: str, path: str) -> float:
        if not host and not path:
            return 0.0
        if self._host is None:
            self._host = lru_cache(1 << 12)(lambda h: self.part(h, 1))
        (a, n), (b, m) = self._host(host) if len(host) < 256 else self.part(host, 1), self.part(path, 2)
        return float(1 / (1 + np.exp(-np.clip(self.bias + (a + b) / (n + m) ** 0.5, -500, 500))))


def fit(labelled: DataFrame, at_most: int = 20_000, rounds: int = 600, rate: float = 2.0, penalty: float = 2e-4) -> Model:
    """A model from the labelled rows (url, label); of more than ``at_most`` those with the smallest hashes of their urls."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.where(F.col("url").isNotNull() & F.col("label").isin(ALLOW, BLOCK))
    rows = rows.select("url", host.alias("host"), path.alias("path"), (F.col("label") == BLOCK).alias("y")).distinct()
    rows = rows.orderBy(F.xxhash64("url"), "url", "y").limit(at_most).collect()
    y = np.array([r["y"] for r in rows], float)
    weights = np.zeros(1 << BITS)
    if not len(y) or y.min() == y.max():
        return Model(weights, 500.0 if len(y) and y[0] else -500.0)
    found = [np.unique(np.concatenate((places(r["host"], 1), places(r["path"], 2)))) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(f) for f in found])
    value = np.repeat([len(f) ** -0.5 for f in found], [len(f) for f in found])
    used, column = np.unique(np.concatenate(found), return_inverse=True)
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w, b, dw, db = np.zeros(len(used)), 0.0, np.zeros(len(used)), 0.0
    for _ in range(rounds):
        z = np.bincount(row, value * w[column], len(rows)) + b
        miss = (1 / (1 + np.exp(-z)) - y) * share
        dw = 0.9 * dw - rate * (np.bincount(column, value * miss[row], len(used)) + penalty * w)
        db = 0.9 * db - rate * miss.sum()
        w, b = w + dw, b + db
    weights[used] = w
    return Model(weights, float(b))


def judge(pages: DataFrame, model: Model, rules: list[tuple[str, str]], least: float = 0.5) -> DataFrame:
    """For each row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, p_block (the model's)."""
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))

    def one(batch: pa.RecordBatch) -> list[tuple]:
        pairs = zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True)
        return [(i, h, p, model.probability(h, p)) for i, (h, p) in zip(batch["page_id"].to_pylist(), pairs, strict=True)]

    scored = map_rows(split, one, "page_id bigint, host string, path string, p_block double")
    rule, verdict = rule_column(rules, F.col("host"), F.col("path"))
    learned = F.when(F.col("p_block") >= least, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "p_block")
