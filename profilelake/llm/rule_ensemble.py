"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees of a random forest are fitted to statistics of labelled texts. Every
path from a root to a node is one rule: a conjunction of bounds on statistics.
A logistic model with an L1 penalty over the rules' truth values keeps the few
that matter, and these are compiled into one Spark column expression: scoring
needs no model object, no Python and no shuffle.

Training uses at most ``sample`` labelled rows, first by a hash of the id, and
never a row of the held-out fold; ids, languages and sources are no inputs. The
statistics of the sample are one small table, fitted on one partition so that a
fit can be repeated; everything else covers all documents.

Cases: null and empty texts have statistics of zero and are scored as such;
without labelled rows, or with one class only, every score is the class's share
(0.5 without rows); several labels of one id count as the best of them; repeated
rows are scored alike.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import and_

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilelake.llm.common import staged, texts

SAMPLE = 8_000
TREES, DEPTH = 16, 3
PENALTY = 0.002
CUT = 0.3
FOLDS = 5

#: A rule: for each statistic's number, what it must exceed and must not exceed.
Rule = tuple[tuple[int, float, float], ...]


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def statistics(rows: DataFrame, *kept: str) -> DataFrame:
    """The kept columns, and ``f``: the whole text's statistics, ``array<double>``."""
    blank = r"[\x20\x09-\x0D]+"
    split = (
        rows.withColumn("words", F.array_remove(F.split("text", blank), ""))
        .withColumn("lines", F.array_remove(F.split("text", "\n"), ""))
        .withColumn("n", F.size("words"))
        .withColumn("size", F.length("text"))
    )

    def share(pattern: str) -> Column:
        count = F.regexp_count("text", F.lit(pattern))
        return F.when(F.col("size") > 0, count / F.col("size")).otherwise(0.0)

    def per(count: Column, of: Column) -> Column:
        return F.when(of > 0, count / of).otherwise(0.0)

    distinct, lines = F.size(F.array_distinct("words")), F.size("lines")
    stats = [
        F.log1p("n"),
        per(F.length(F.array_join("words", "")), F.col("n")),
        per(distinct, F.sqrt("n")),
        per(distinct, F.col("n")),
        per(lines - F.size(F.array_distinct("lines")), lines),
        per(F.col("n"), lines),
        share(r"\p{Lu}"),
        share("[#*$%&]"),
        share(r"[|<>{}\[\]]"),
        share("!"),
        share("[0-9]"),
        share("[.,]"),
    ]
    return split.select(*kept, F.array(*(s.cast("double") for s in stats)).alias("f"))


def training_rows(labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, label) of at most ``sample`` rows outside the held-out fold."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    return (
        usable.filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )


def tree_rules(description: str) -> list[Rule]:
    """The rules of one tree, from its printed form: one for each node but the root."""
    step = re.compile(r"( *)(If|Else) \(feature (\d+) (<=|>) ([-+.\deE]+)\)")
    rules, path = [], {}
    for line in description.splitlines():
        found = step.match(line)
        if not found:
            continue
        depth, number, bound = len(found[1]), int(found[3]), float(found[5])
        path = {d: v for d, v in path.items() if d < depth}
        path[depth] = (number, found[4] == ">", bound)
        low, high = {}, {}
        for feature, above, value in path.values():
            if above:
                low[feature] = max(value, low.get(feature, value))
            else:
                high[feature] = min(value, high.get(feature, value))
        infinity = float("inf")
        rules.append(
            tuple((k, low.get(k, -infinity), high.get(k, infinity)) for k in sorted({*low, *high}))
        )
    return rules


def holds(rule: Rule, f: Column) -> Column:
    """The rule as a column expression."""
    bounds = []
    for number, low, high in rule:
        value = F.get(f, F.lit(number))
        if low != -float("inf"):
            bounds.append(value > low)
        if high != float("inf"):
            bounds.append(value <= high)
    return reduce(and_, bounds)


def fit(
    documents: DataFrame, labels: DataFrame, sample: int = SAMPLE
) -> tuple[float, list[tuple[Rule, float]]]:
    """The intercept (in log odds) and the rules with their weights."""
    chosen = F.broadcast(training_rows(labels, sample))
    wanted = statistics(texts(documents).join(chosen, "doc_id"), "doc_id", "label")
    rows = wanted.dropDuplicates(["doc_id"]).coalesce(1).sortWithinPartitions("doc_id")
    rows = staged(rows, "training").coalesce(1).withColumn("features", array_to_vector("f"))
    shares = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("ones")).first()
    if not shares["n"] or shares["ones"] in (0.0, 1.0):
        ones = 0.5 if not shares["n"] else min(max(shares["ones"], 1e-9), 1 - 1e-9)
        return math.log(ones / (1 - ones)), []
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="all", subsamplingRate=0.5, seed=7
    ).fit(rows)
    rules = sorted({r for tree in forest.trees for r in tree_rules(tree.toDebugString)})
    truths = F.array(*(holds(r, F.col("f")).cast("double") for r in rules))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=60)
    fitted = lasso.fit(rows.select("label", array_to_vector(truths).alias("features")))
    weights = fitted.coefficients.toArray()
    return float(fitted.intercept), [
        (r, float(w)) for r, w in zip(rules, weights, strict=True) if w
    ]


def score(f: Column, model: tuple[float, list[tuple[Rule, float]]]) -> Column:
    """The ensemble compiled into one expression: the odds of label 1, 0 to 1."""
    intercept, rules = model
    total = F.lit(intercept)
    for rule, weight in rules:
        total = total + F.when(holds(rule, f), F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def classify(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: fold, score and prediction."""
    scored = statistics(texts(documents), "doc_id").withColumn(
        "score", score(F.col("f"), fit(documents, labels, sample))
    )
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    model = fit(documents, labels, sample)
    rows = documents.select(
        F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("text")
    )
    # The random column keeps Spark from moving the filter below the statistics, which
    # would compute them anew for every rule.
    scored = statistics(rows, "row").withColumn("fence", F.rand(0))
    kept = scored.filter((score(F.col("f"), model) >= CUT) & (F.col("fence") >= 0))
    return kept.select("row.*")
