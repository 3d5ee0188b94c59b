"""Personal data by boosted candidates.

Strict patterns with validators give the base spans.  Next to them loose,
high-recall generators propose overlapping spans: anything around an ``@``,
any long run of digits and separators (as a card, a phone and, with dots, as
an address) and any long mixed token (as a secret).  Boosted trees score every
proposal from its format and its surroundings, and a threshold per kind,
calibrated on proposals that the trees have not seen, selects those that are
redacted beside the base spans.

All work on texts is done with built-in functions, inside the row: spans are
arrays of structs, and the trees become one SQL expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorcast.llm.common import drop_stored, stored

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("secret",)

# Base patterns, written so that a long run is walked once: a match can only
# begin at the start of a run (or where the last match ended), and quantifiers
# whose follower is not in their class do not give characters back.
BASE_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_IP_VALID = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"

# generators: pattern, what a text must contain to be searched, kinds proposed
GENERATORS = (
    (r"(?<![^\s<>\"'(\[,;])[^\s@<>\"'(\[,;]*+@[^\s<>\"')\],;]++", "@", ("email",)),
    (r"(?<![0-9])\+?[0-9(][0-9\x20()./-]{5,}[0-9]", None, ("card", "phone", "ip")),
    (r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{16,}+", None, ("secret",)),
)
_CUES = r"(?i)(?:mail|phone|tel|call|fax|card|visa|account|host|server|addr|contact)"
_SECRET_CUE = r"(?i)(?:key|token|secret|passw|pwd|auth|bearer)[A-Za-z]*[\s\"':=]*$"
CONTEXT_CHARS = 24

TREES, DEPTH = 12, 4
PRECISION = 0.9
# thresholds are multiples of one part in so many
STEPS = 2000
# MLlib takes split points from all rows up to the square of this number of different ones
MAX_BINS = 1024

_SPANS = "array<struct<kind:string,start:int,end:int,body:string>>"
FEATURES = ("n_chars", "n_digits", "n_letters", "n_dots", "n_marks", "plus", "at", "longest_run", "kind",
            "letter_before", "letter_after", "cue", "line_start")


def match_spans(text: Column, pattern: str, kind: str, must: str | None = None) -> Column:
    """All matches as structs of kind, start, end (code points, exclusive) and body.

    The texts between the matches come from splitting at the same pattern, so
    a running sum of lengths places every match.
    """
    hit = text.contains(must) if must else F.lit(True)
    none = F.array().cast("array<string>")
    found = F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
    pairs = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("gap"), found.alias("body"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["body"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["body"].alias("body"))
        return F.struct(end.alias("at"), F.array_append(acc["out"], span).alias("out"))

    def part(pieces):
        return F.aggregate(pieces, F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out")), step)

    def moved(acc, x):
        return F.struct((acc["at"] + x["at"]).alias("at"),
                        F.array_append(acc["out"], F.struct(acc["at"].alias("base"), x["out"].alias("spans"))).alias("out"))
    none_yet = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<base:int,spans:{_SPANS}>>").alias("out"))

    def placed(all_pairs):
        parts = F.transform(_cuts(all_pairs), lambda p: part(p))
        return F.flatten(F.transform(F.aggregate(parts, none_yet, moved)["out"], lambda c: F.transform(c["spans"], lambda s: F.struct(
            s["kind"].alias("kind"), (s["start"] + c["base"]).alias("start"), (s["end"] + c["base"]).alias("end"), s["body"].alias("body")))))
    return F.when(F.size(found) > 0, _once(pairs, placed)).otherwise(F.array().cast(_SPANS))


def _once(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` made once, however often ``fn`` uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _cuts(items: Column) -> Column:
    """An array as parts of about the square root of its size (64 at least), so
    that folds that append item by item copy little."""
    size = F.greatest(F.lit(64), F.ceil(F.sqrt(F.size(items)))).cast("int")
    first = F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), size)
    return F.transform(first, lambda k: F.slice(items, k + 1, size))


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right counts twice (its digit sum); the total ends in 0."""
    backwards = F.split(F.reverse(digits), "")
    values = F.transform(F.filter(backwards, lambda c: c != ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def _valid(kind: str, body: Column) -> Column:
    n = F.length(_digits(body))
    if kind == "ip":
        return body.rlike(_IP_VALID)
    if kind == "card":
        return n.between(13, 19) & _luhn(_digits(body))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def with_base_spans(docs: DataFrame) -> DataFrame:
    """Add ``base``: the valid matches of the base patterns, by kind as listed, then start."""
    text = F.coalesce(F.col("text"), F.lit(""))
    raw = docs.select("*", *[match_spans(text, BASE_PATTERNS[k], k, "@" if k == "email" else "+" if k == "phone" else None)
                             .alias(f"_{k}") for k in BASE_KINDS])

    def valid(kind):
        return F.filter(F.col(f"_{kind}"), lambda s: _valid(kind, s["body"]))
    kept = F.concat(*[valid(k) for k in BASE_KINDS])
    return raw.withColumn("base", kept).drop(*[f"_{k}" for k in BASE_KINDS])


def _features(text: Column, span: Column) -> Column:
    body = span["body"]

    def share(kept):
        return F.length(F.regexp_replace(body, f"[^{kept}]", "")).cast("double")
    before = F.substring(text, F.greatest(span["start"] - CONTEXT_CHARS + 1, F.lit(1)),
                         F.least(span["start"], F.lit(CONTEXT_CHARS)))
    after = F.substring(text, span["end"] + 1, F.lit(1))
    runs = F.array_max(F.transform(F.split(body, "[^0-9]+"), lambda r: F.length(r)))
    secret = span["kind"] == "secret"
    values = (F.length(body).cast("double"), share("0-9"), share("A-Za-z"), share("."), share(" ()/-"),
              body.contains("+").cast("double"), body.contains("@").cast("double"), F.coalesce(runs, F.lit(0)).cast("double"),
              F.array_position(F.array(*[F.lit(k) for k in KINDS]), span["kind"]).cast("double"),
              before.rlike("[A-Za-z]$").cast("double"), after.rlike("^[A-Za-z]").cast("double"),
              # the cue of a secret is its training label
              F.when(secret, 0.0).otherwise(before.rlike(_CUES).cast("double")),
              (before.rlike(r"\n$") | (span["start"] == 0)).cast("double"))
    return F.struct(*[v.alias(n) for n, v in zip(FEATURES, values)])


def with_proposals(docs: DataFrame) -> DataFrame:
    """Add ``proposals``: structs of kind, start, end, body, features and weak label.

    The label says that a proposal overlaps a base span of its kind; for a
    secret, that a word such as key or token introduces it.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    raw = docs.select("*", *[match_spans(text, p, kinds[0], must).alias(f"_g{i}")
                             for i, (p, must, kinds) in enumerate(GENERATORS)])

    def named(spans, kind):
        return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"),
                                                     s["end"].alias("end"), s["body"].alias("body")))
    parts = []
    for i, (_, _, kinds) in enumerate(GENERATORS):
        for kind in kinds:
            spans = F.col(f"_g{i}")
            if kind == "ip":
                spans = F.filter(spans, lambda s: s["body"].rlike(r"^[0-9]+(?:\.[0-9]+){3,}$"))
            parts.append(named(spans, kind))

    def full(s):
        before = F.substring(text, F.greatest(s["start"] - CONTEXT_CHARS + 1, F.lit(1)),
                             F.least(s["start"], F.lit(CONTEXT_CHARS)))
        overlaps = F.exists("base", lambda b: (b["kind"] == s["kind"]) & (b["start"] < s["end"]) & (s["start"] < b["end"]))
        label = F.when(s["kind"] == "secret", before.rlike(_SECRET_CUE)).otherwise(overlaps)
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        s["body"].alias("body"), _features(text, s).alias("f"), label.alias("label"))
    made = raw.withColumn("_all", F.concat(*parts)).drop(*[f"_g{i}" for i in range(len(GENERATORS))])
    return made.withColumn("proposals", F.transform("_all", full)).drop("_all")


@dataclass
class Selector:
    """Boosted trees as nested (feature, threshold, left, right) tuples or leaf
    values, their weights, and the least probability that each kind needs."""

    trees: list
    weights: list[float]
    thresholds: dict[str, float]

    def probability(self, features: Column) -> Column:
        def walk(node):
            if isinstance(node, float):
                return F.lit(node)
            name, at, left, right = node
            return F.when(features[name] <= F.lit(at), walk(left)).otherwise(walk(right))
        margin = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights):
            margin = margin + F.lit(weight) * walk(tree)
        return 1.0 / (1.0 + F.exp(-2.0 * margin))

    def selects(self, proposal: Column) -> Column:
        least = F.lit(2.0)  # no probability reaches it
        for kind, at in self.thresholds.items():
            least = F.when(proposal["kind"] == kind, F.lit(at)).otherwise(least)
        return self.probability(proposal["f"]) >= least


def _read_tree(node):
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return FEATURES[split.featureIndex()], float(split.threshold()), _read_tree(node.leftChild()), _read_tree(node.rightChild())


def calibrate(rows: list[tuple], precision: float = PRECISION) -> dict[str, float]:
    """Per kind the least probability from which on the proposals are right
    with the given precision; kinds without one get none.  A row is kind,
    probability, whether it is right, and how many such proposals there are
    (one if not given)."""
    out = {}
    for kind in KINDS:
        own = sorted(((p, y, n[0] if n else 1) for k, p, y, *n in rows if k == kind), reverse=True)
        seen = right = 0
        for i, (p, y, n) in enumerate(own, 1):
            seen += n
            right += n * y
            if right >= precision * seen and right >= 3 and (i == len(own) or own[i][0] < p):
                out[kind] = p
    return out


def training_rows(docs: DataFrame) -> DataFrame:
    """The proposals of all documents: kind, features, label, ``calibrates``
    and ``n``, the number of proposals that have these values.

    A third of the documents, by a hash of the id (of the text where there is
    none), calibrates.
    """
    fold = F.xxhash64(F.lit("fold"), F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))) % 3 == 0
    # no generator matches without a digit or an at sign
    found = with_proposals(with_base_spans(docs.where(F.col("text").rlike("[0-9@]")).select("doc_id", "text")))
    # the outer kind, as the other has the proposals made again in an inferred filter
    rows = (found.select(fold.alias("calibrates"), F.explode_outer("proposals").alias("p")).where("p.kind is not null")
            .select("calibrates", F.col("p.kind").alias("of"), F.col("p.label").cast("double").alias("label"), "p.f.*"))
    return rows.groupBy("calibrates", "of", "label", *FEATURES).agg(F.count(F.lit(1)).alias("n"))


def fit(docs: DataFrame) -> Selector:
    """Train trees and thresholds on the proposals of all documents.

    Proposals with the same kind, features and label are one weighted row.
    The driver gets the trees and, per kind, step of probability and label,
    one number.
    """
    rows, path = stored(training_rows(docs), "pii-training-rows")
    try:
        seen = {r["label"] for r in rows.where("not calibrates").select("label").distinct().collect()}
        if len(seen) < 2:
            return Selector([], [], {})
        weighted = rows.where("not calibrates").withColumn("weight", F.col("n").cast("double"))
        assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="v").transform(weighted)
        model = GBTClassifier(featuresCol="v", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, maxBins=MAX_BINS, seed=11) \
            .fit(assembled.select("v", "label", "weight"))
        trees = [_read_tree(t._java_obj.rootNode() if hasattr(t, "_java_obj") else t._call_java("rootNode"))
                 for t in model.trees]
        selector = Selector(trees, [float(w) for w in model.treeWeights], {})
        step = F.floor(selector.probability(F.struct(*FEATURES)) * STEPS)
        # at most kinds x (STEPS + 1) x 2 rows
        held = rows.where("calibrates").groupBy("of", step.alias("step"), "label").agg(F.sum("n").alias("n")).collect()
        selector.thresholds = calibrate([(r["of"], r["step"] / STEPS, r["label"] > 0, r["n"]) for r in held])
        return selector
    finally:
        drop_stored(docs.sparkSession, path)


def _order(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def detect(docs: DataFrame, selector: Selector | None = None) -> DataFrame:
    """Add ``base`` and ``spans`` (base and selected proposals) to the rows.

    ``spans`` are sorted by kind as listed, then start.  A selected proposal
    that overlaps a base span of any kind adds nothing to it and is left out.
    Null and empty texts have no spans; every input row gives one output row
    and keeps its columns.
    """
    if selector is None:
        selector = fit(docs)
    found = with_base_spans(docs)
    plain = "array<struct<kind:string,start:int,end:int>>"
    bare = F.transform("base", lambda s: F.struct(s["kind"], s["start"], s["end"])).cast(plain)
    if not selector.thresholds:
        return found.withColumn("spans", bare).withColumn("base", bare)
    found = with_proposals(found)
    chosen = F.filter("proposals", lambda p: selector.selects(p) & ~F.exists(
        "base", lambda b: (b["start"] < p["end"]) & (p["start"] < b["end"])))
    found = found.withColumn("_chosen", F.when(F.size("proposals") > 0, F.transform(
        chosen, lambda s: F.struct(s["kind"], s["start"], s["end"]))).otherwise(F.array()).cast(plain)).drop("proposals")
    keyed = F.transform(F.concat(bare, F.col("_chosen")), lambda s: F.struct(
        _order(s["kind"]).alias("o"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    spans = F.transform(F.array_sort(F.array_distinct(keyed)), lambda s: F.struct(s["kind"], s["start"], s["end"])).cast(plain)
    return found.withColumn("spans", F.when(F.size("_chosen") > 0, spans).otherwise(bare)).drop("_chosen") \
        .withColumn("base", bare)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` of every row."""
    found = detect(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, selector: Selector | None = None) -> DataFrame:
    """The rows with every span of ``text`` replaced by its kind in brackets.

    Overlapping spans become one mark, of the kind that begins first (of equal
    starts the longer).  The columns stay as they are; ``n_chars``, if there,
    counts the new text.
    """
    columns = docs.columns
    slim = docs.select("*").withColumnRenamed("base", "_user_base") if "base" in columns else docs
    found = detect(slim, selector or fit(docs))
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    none_yet = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def reach(items):
        """For each span the end of what lies before it, in its part."""
        def step(acc, s):
            return F.struct(F.greatest(acc["at"], -s["back"]).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out"))
        return F.transform(_cuts(items), lambda p: F.struct(F.aggregate(p, none_yet, step).alias("r"), p.alias("p")))

    def carried(parts):
        """The same over all parts; what a part adds is known from the ends before it."""
        def step(acc, x):
            return F.struct(F.greatest(acc["at"], x["r"]["at"]).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out"))
        before = F.aggregate(parts, none_yet, step)
        return F.struct(before["at"].alias("end"), F.flatten(F.zip_with(parts, before["out"], lambda x, b: F.zip_with(
            x["p"], x["r"]["out"], lambda s, a: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), F.greatest(a, b).alias("before"))))).alias("s"))

    def marked(c):
        outside = F.filter(c["s"], lambda s: s["start"] >= s["before"])
        pieces = F.transform(outside, lambda s: F.concat(F.substring(F.col("text"), s["before"] + 1, s["start"] - s["before"]),
                                                         F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.concat(F.array_join(pieces, ""), F.substring(F.col("text"), c["end"] + 1, F.length("text")))
    text = F.when(F.size("spans") > 0, _once(ordered, lambda o: _once(reach(o), lambda r: _once(carried(r), marked)))).otherwise(F.col("text"))
    out = found.withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    out = out.drop("base", "spans")
    if "_user_base" in out.columns:
        out = out.withColumnRenamed("_user_base", "base")
    return out.select(*[f"`{c}`" for c in columns])
