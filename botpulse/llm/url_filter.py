"""URL filter: allow and block rules, and gradient-boosted trees on lexical features for the rest.

*Rules.* A rule is a verdict, a host and the start of a path; it fits its host and all subdomains. The
longest rule that fits decides.

*Features*, all by SQL functions: length, path depth, digit ratio, Shannon entropy of the
characters, numbers of parameters and host labels, and statistics of four suffixes: last host label,
last two host labels, first path segment, file extension. A suffix's statistics are the pages that have it
and the share of blocked ones among those that a rule decides, counted over all pages. For a page that a
rule decides, the share is counted without its fold of the URLs, so that no page sees its own label.

*Training.* The URLs decided by a rule are the labelled ones. The trees are fitted on the distinct ones, or, where
there are more than about ``labelled`` of them, on those with the smallest hashes; counts and statistics cover
all pages. The rest is judged by the trees.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botpulse.functions.joins import hot_keys, split_join
from botpulse.llm.common import staged

Rule = tuple[str, str, str]  # verdict, host, start of the path
LABELLED = 100_000  # labelled URLs that the trees are fitted on, about
FOLDS = 5
PRIOR = 2.0  # a suffix's share of blocked pages counts this many pages of the overall share
TREES, DEPTH, LEARNING_RATE = 20, 4, 0.3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SUFFIXES = ("last_label", "two_labels", "section", "extension")
LEXICAL = ("length", "depth", "digits", "entropy", "params", "labels")
FEATURES = [*LEXICAL, *(f"{s}_{v}" for s in SUFFIXES for v in ("pages", "blocked"))]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def deciding_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule that fits, as host and path together; null if none does.

    Of two rules alike in host and path the first counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, at, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # longer ones wrap shorter ones
        fits = ((host == at) | F.endswith(host, F.lit(f".{at}"))) & F.startswith(path, F.lit(start))
        known = rule.eqNullSafe(F.lit(at + start))
        verdict = F.when(fits & ~known, F.lit(decision)).otherwise(verdict)
        rule = F.when(fits, F.lit(at + start)).otherwise(rule)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Shannon entropy in bits of a text's characters; 0 for an empty one."""
    whole = F.length(text).cast("double")

    def part(total: Column, char: Column) -> Column:
        share = (whole - F.length(F.replace(text, char, F.lit("")))) / whole
        return total - F.when(share > 0, share * F.log2(share)).otherwise(0.0)

    chars = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.aggregate(chars, F.lit(0.0), part)


def lexical_columns(url: Column, host: Column, path: Column) -> dict[str, Column]:
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    labels = F.filter(F.split(host, r"\."), lambda s: s != "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    extension = F.regexp_extract(F.element_at(F.concat(F.array(F.lit("")), segments), -1), r"\.([^.]*)$", 1)
    last = F.array_join(F.slice(F.concat(F.array(F.lit("")), labels), -1, 1), ".")
    two = F.array_join(F.slice(F.concat(F.array(F.lit(""), F.lit("")), labels), -2, 2), ".")
    return {
        "length": F.length(url).cast("double"),
        "depth": F.size(segments).cast("double"),
        "digits": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(F.length(url), F.lit(1)),
        "entropy": entropy(url),
        "params": F.size(F.filter(F.split(query, "&"), lambda s: s != "")).cast("double"),
        "labels": F.size(labels).cast("double"),
        "last_label": last, "two_labels": two, "section": F.coalesce(F.get(segments, F.lit(0)), F.lit("")),
        "extension": extension,
    }


def with_suffix_statistics(urls: DataFrame) -> DataFrame:
    """``urls`` with ``{suffix}_pages`` and ``{suffix}_blocked``; needs ``row``, ``fold``, ``decided`` and the suffixes.

    Hot suffixes (a few hold most pages) are counted map-side and joined by broadcast, all others by a shuffle.
    """
    keyed = staged(urls.select("row", "fold", "decided", F.explode(F.array(
        *[F.concat(F.lit(f"{i}:"), F.col(s)) for i, s in enumerate(SUFFIXES)])).alias("key")), "url-suffixes")
    blocked = F.when(F.col("decided") == "block", 1).otherwise(0)
    counts = [c for f in range(FOLDS) for c in (
        F.sum(F.when((F.col("fold") == f) & F.col("decided").isNotNull(), 1).otherwise(0)).alias(f"l{f}"),
        F.sum(F.when(F.col("fold") == f, blocked).otherwise(0)).alias(f"b{f}"))]
    stats = staged(keyed.groupBy("key").agg(F.count("*").alias("pages"), *counts), "suffix-counts")
    total = urls.agg(F.count("decided").alias("l"), F.coalesce(F.sum(blocked), F.lit(0)).alias("b")).first()
    overall = (total.b + 0.5) / (total.l + 1.0)
    joined = split_join(keyed, stats, "key", hot=hot_keys(keyed, "key"))

    def without_own_fold(name: str) -> Column:
        own = F.col("decided").isNotNull()
        return sum((F.when(own & (F.col("fold") == f), 0).otherwise(F.col(f"{name}{f}")) for f in range(FOLDS)), F.lit(0))

    share = (without_own_fold("b") + PRIOR * overall) / (without_own_fold("l") + PRIOR)
    kind = F.substring_index("key", ":", 1)
    wide = joined.select("row", kind.alias("kind"), F.log1p("pages").alias("pages"), share.alias("blocked")).groupBy("row").agg(
        *[F.max(F.when(F.col("kind") == str(i), F.col(v))).alias(f"{s}_{v}")
          for i, s in enumerate(SUFFIXES) for v in ("pages", "blocked")])
    return urls.join(wide, "row")


def fitted(labelled: DataFrame):
    """Trees fitted on ``FEATURES`` and ``decided``; None if there are not both verdicts."""
    if {r[0] for r in labelled.select("decided").distinct().collect()} != {"allow", "block"}:
        return None
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        labelled.select(*FEATURES, F.when(F.col("decided") == "block", 1.0).otherwise(0.0).alias("label")))
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=LEARNING_RATE, seed=13).fit(vectors)


def sampled(featured: DataFrame, labelled: int) -> DataFrame:
    """The distinct labelled URLs, or about ``labelled`` of them with the smallest hashes."""
    known = featured.where("decided IS NOT NULL")
    distinct = known.select("url").distinct().count()
    span = 1 << 40
    if distinct > labelled:
        known = known.where(F.pmod(F.xxhash64(F.lit(13), F.col("url")), F.lit(span)) < int(span * labelled / distinct))
    return known.dropDuplicates(["url"])


def url_verdicts(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
                 labelled: int = LABELLED) -> DataFrame:
    """``(id_col, host, path, rule, verdict, score)`` for every row: the longest fitting rule's verdict, else the trees'.

    ``score`` is the trees' probability of ``block``, null where a rule decides. A null URL, and one
    without ``://``, has an empty host and path: no rule fits, the trees judge its features. Where no
    rule decides any URL, all are allowed; where all decided URLs agree, the rest gets their verdict. Equal URLs get
    equal verdicts, repeated rows stay. URLs are read whole. An empty table gives an empty one. Only the named columns are
    read, so other columns can't clash.
    """
    url = F.coalesce(pages[f"`{url_col}`"].cast("string"), F.lit(""))
    base = pages.select(pages[f"`{id_col}`"].alias("id"), url.alias("url"))
    base = base.select("id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = deciding_rule(F.col("host"), F.col("path"), rules)
    base = base.withColumns({
        "rule": rule, "decided": verdict, "fold": F.pmod(F.xxhash64(F.lit(7), F.col("url")), F.lit(FOLDS)),
        "row": F.monotonically_increasing_id(), **lexical_columns(F.col("url"), F.col("host"), F.col("path"))})
    urls = staged(base, "urls")
    featured = staged(with_suffix_statistics(urls), "url-features")
    trees = fitted(staged(sampled(featured, labelled), "labelled-urls"))
    if trees is None:
        one = featured.where("decided IS NOT NULL").select("decided").first()
        judged, score = featured, F.lit(None).cast("double")
        method = F.lit(one[0] if one else "allow")
    else:
        judged = trees.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(featured))
        score = vector_to_array(F.col("probability"))[1]
        method = F.when(score > 0.5, "block").otherwise("allow")
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("decided", method).alias("verdict"),
                         F.when(F.col("decided").isNull(), score).alias("score"))

