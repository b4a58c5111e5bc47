"""Quality: a sparse ensemble of rules over text statistics.

A small forest is grown on the statistics; each path of each tree is a conjunctive rule; lasso
logistic regression picks and weights the rules; the weighted rules become one Spark column.

Cases: a null text is the empty text, whose statistics are 0 (its one empty line is distinct: 1); equal
rules of different trees count once; without labelled rows every score is 0.5, with one class the share
of that class (0 or 1). Scoring is row by row: repeated rows repeat, extra columns pass through, long texts count whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe.workspace import materialise

TRAIN_DOCS = 20_000   # at most so many labelled documents are fitted on
TREES, DEPTH = 12, 4
LASSO = 0.001
NAMES = ("chars", "words", "word_length", "distinct_words", "distinct_lines", "line_length", "capitals", "digits", "stops", "signs", "shouts")


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text, each a Spark expression."""
    text = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    count = F.greatest(F.size(words), F.lit(1))
    lines = F.split(text, "\n")
    share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / size
    return dict(zip(NAMES, (
        F.length(text).cast("double"),
        F.size(words).cast("double"),
        F.length(text) / count,
        F.size(F.array_distinct(words)) / count,
        F.size(F.array_distinct(lines)) / F.size(lines),
        F.length(text) / F.size(lines),
        share(r"\p{Lu}+"),
        share("[0-9]+"),
        share("[.?!]+"),
        share(r"[^\p{L}\p{N}\s.,;:'\"()?!-]+"),
        share("!+"),
    ), strict=True))


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool       # name > bound, else name <= bound
    bound: float

    def column(self) -> Column:
        return F.col(self.name) > self.bound if self.above else F.col(self.name) <= self.bound


Rule = tuple[Condition, ...]


@dataclass
class Ensemble:
    base: float
    rules: list[tuple[Rule, float]]
    constant: float | None = None    # the score where there was nothing to learn

    def score(self) -> Column:
        """The probability of label 1 from the statistics' columns."""
        if self.constant is not None:
            return F.lit(float(self.constant))
        total = reduce(lambda z, r: z + F.when(compiled(r[0]), r[1]).otherwise(0.0), self.rules, F.lit(self.base))
        return 1 / (1 + F.exp(-total))


def compiled(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, (c.column() for c in rule))


def tree_paths(node, above: Rule = ()) -> list[Rule]:
    """Every path from the root to a node below it."""
    found = [above] if above else []
    if node.getClass().getSimpleName() != "LeafNode":
        split = node.split()
        name, bound = NAMES[split.featureIndex()], float(split.threshold())
        found += tree_paths(node.leftChild(), (*above, Condition(name, False, bound)))
        found += tree_paths(node.rightChild(), (*above, Condition(name, True, bound)))
    return found


def tightened(rule: Rule) -> Rule:
    """One bound per statistic and side, in a fixed order, so that equal rules are equal values."""
    kept: dict[tuple[str, bool], float] = {}
    for c in rule:
        key = (c.name, c.above)
        kept[key] = c.bound if key not in kept else (max if c.above else min)(kept[key], c.bound)
    return tuple(Condition(n, a, b) for (n, a), b in sorted(kept.items()))


def fit(docs: DataFrame, labels: DataFrame) -> Ensemble:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1; at most TRAIN_DOCS rows, see ``bounded_labels``)."""
    taken = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id")  # at most TRAIN_DOCS rows of 16 bytes
    sample = materialise(taken.select("label", *(c.alias(n) for n, c in statistics(F.col("text")).items())), "statistics")
    n, positive = sample.agg(F.count("*"), F.sum("label")).first()
    if not n:
        return Ensemble(0.0, [], 0.5)
    if positive in (0, n):
        return Ensemble(0.0, [], positive / n)
    rows = VectorAssembler(inputCols=list(NAMES), outputCol="features").transform(sample)
    forest = RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=11, featureSubsetStrategy="onethird", minInstancesPerNode=5)
    rules = sorted({tightened(p) for tree in forest.fit(rows).trees for p in tree_paths(tree._java_obj.rootNode())},
                   key=lambda r: [(c.name, c.above, c.bound) for c in r])
    if not rules:
        return Ensemble(0.0, [], positive / n)
    held = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="held")
    tested = held.transform(sample.select("label", *(compiled(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)))).select("label", "held")
    lasso = LogisticRegression(labelCol="label", featuresCol="held", elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60)
    weights = lasso.fit(materialise(tested, "rules"))
    return Ensemble(float(weights.intercept), [(r, float(w)) for r, w in zip(rules, weights.coefficients) if w])


def score_quality(docs: DataFrame, ensemble: Ensemble, text: str = "text", keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """Adds the probability that a text is of good quality; ``keep`` (all by default) goes along."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != name.lower()]
    carried = F.struct(*keep).alias("row")  # statistics and kept columns may share names
    return (docs.select(carried, *(c.alias(n) for n, c in statistics(F.col(text)).items()))
            .select("row", ensemble.score().alias("made")).select("row.*", F.col("made").alias(name)))
