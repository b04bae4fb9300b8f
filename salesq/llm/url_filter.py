"""URL filters: explicit rules, then a path-template tree per host.

Rules name a host (its subdomains included) and a path prefix; the longest that
fits decides. Other URLs go to the template tree: runs of digits in a segment
become ``0``, and a branching point with more than ``CHILDREN`` different segments
becomes the wildcard ``*``. The statistics of sibling templates whose reject rates
do not differ from their parent's (a two-sided test at ``SIMILAR`` deviations) are
merged. A template's purity is its share of rejected labelled pages, smoothed
towards its parent's, that towards the host's, that towards the whole table's;
templates of a purity above ``PURITY`` are blocked.

All of it runs on counts per distinct (host, digit-free path), so a host with a
third of all pages is a few rows; pages join their verdict by that key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesq.llm.common import written

CHILDREN, DEPTH, SIMILAR, SMOOTH, PURITY = 20, 8, 2.0, 10.0, 0.5
# The contract's rules (verdict, host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL or without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host, path, rules=RULES) -> F.Column:
    """The longest rule that fits, as struct(rule, verdict), or NULL."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1].find("/"))):  # later ones win
        name, slash, tail = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + tail)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _purity(rejected, labelled, prior):
    return (rejected + SMOOTH * prior) / (labelled + SMOOTH)


def template_purity(paths: DataFrame) -> DataFrame:
    """``paths(host, shape, labelled, rejected)``, one row a distinct shape, ->
    ``host, shape, template, purity``. Segments past ``DEPTH`` form one last one."""
    parts = F.split("shape", "/", DEPTH + 1)
    tree = written(paths.withColumn("parts", parts).withColumn("parent", F.lit("")).withColumn("template", F.lit("")), "url-tree")
    depth = tree.agg(F.max(F.size("parts"))).first()[0] or 0
    for k in range(1, depth):  # element 0 stands before the first slash
        here = tree.filter(F.size("parts") > k)
        wide = (here.groupBy("host", "template").agg(F.count_distinct(F.col("parts")[k]).alias("branches"))
                .filter(F.col("branches") > CHILDREN).select("host", "template", F.lit(True).alias("wide")))
        segment = F.when(F.size("parts") <= k, F.lit("")).otherwise(
            F.concat(F.lit("/"), F.when(F.col("wide"), F.lit("*")).otherwise(F.col("parts")[k])))
        tree = tree.join(wide, ["host", "template"], "left").select(
            "host", "shape", "labelled", "rejected", "parts",
            F.when(F.size("parts") > k, F.col("template")).otherwise(F.col("parent")).alias("parent"),
            F.concat("template", segment).alias("template"))
        tree = written(tree, "url-tree")
    sums = [F.sum("labelled").alias("labelled"), F.sum("rejected").alias("rejected")]
    leaves = written(tree.groupBy("host", "parent", "template").agg(*sums), "url-leaves")
    parents = leaves.groupBy("host", "parent").agg(*sums).withColumnsRenamed({"labelled": "up_labelled", "rejected": "up_rejected"})
    near = leaves.join(parents, ["host", "parent"])
    rate = F.col("up_rejected") / F.greatest(F.col("up_labelled"), F.lit(1))
    gap = F.abs(F.col("rejected") - F.col("labelled") * rate)
    near = near.withColumn("similar", gap <= SIMILAR * F.sqrt(F.col("labelled") * rate * (1 - rate)) + 1e-9)
    pool = near.filter("similar").groupBy("host", "parent").agg(F.sum("labelled").alias("pool_labelled"), F.sum("rejected").alias("pool_rejected"))
    hosts = leaves.groupBy("host").agg(F.sum("labelled").alias("host_labelled"), F.sum("rejected").alias("host_rejected"))
    whole = leaves.agg(F.sum("labelled"), F.sum("rejected")).first()
    overall = (whole[1] or 0) / max(whole[0] or 0, 1)
    merged = near.join(pool, ["host", "parent"], "left").join(hosts, "host")
    of_host = _purity(F.col("host_rejected"), F.col("host_labelled"), F.lit(overall))
    of_parent = _purity(F.col("up_rejected"), F.col("up_labelled"), of_host)
    purity = F.when(F.col("similar"), _purity(F.col("pool_rejected"), F.col("pool_labelled"), of_parent)).otherwise(
        _purity(F.col("rejected"), F.col("labelled"), of_parent))
    return tree.join(merged.select("host", "parent", "template", purity.alias("purity")), ["host", "parent", "template"]).select(
        "host", "shape", "template", "purity")


def judge(pages: DataFrame, labels: DataFrame | None = None, rules=RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` of every row.

    ``labels(page_id, reject)`` marks pages known as good or bad (rows that repeat
    a page count once; pages without a label count for none). A NULL URL, or one
    without ``://``, has an empty host and path and the template tree's verdict on
    those; repeated rows keep their rows; an empty table gives an empty result;
    with no label at all every template is allowed. Other columns are not read."""
    spark = pages.sparkSession
    host, path = url_parts(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("shape", F.regexp_replace("path", "[0-9]+", "0"))
    if labels is None:
        labels = spark.createDataFrame([], "page_id long, reject boolean")
    marks = labels.filter("page_id is not null and reject is not null").groupBy("page_id").agg(F.max("reject").alias("reject"))
    paths = rows.join(marks, "page_id", "left").groupBy("host", "shape").agg(
        F.count("reject").alias("labelled"), F.coalesce(F.sum(F.col("reject").cast("long")), F.lit(0)).alias("rejected"))
    judged = rows.join(template_purity(paths), ["host", "shape"]).withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("purity") > PURITY, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", F.col("r.rule").alias("rule"),
                         F.coalesce("r.verdict", own).alias("verdict"), "template", "purity")
