"""Personal data: fixed forms, and boosted trees over candidate spans.

High-recall generators propose spans that may overlap: address-like, number-like, dotted or coloned groups,
account-like. Of a run of numbers or of an account's groups, each group and neighbouring groups of the size of a phone, a card or an
account are proposed besides the whole. Each gets features of its format and of the characters around it. Gradient-boosted
trees learn on a bounded sample (``SAMPLE`` candidates, the smallest by a hash over all of them) which
candidates evidence of their own confirms: an address that has the email form once its "(at)" and "(dot)" are
read, an IBAN's remainder by 97, address groups that parse, a valid card number, an international number or a national
phone plan with the grouping or the words of a phone. What a check tests and the features do not see (check
digits, ranges) makes the rest hard negatives. What only overlaps a fixed form is no label either way. Scores are calibrated
by isotonic regression on the whole sample, each quarter scored by trees fitted to the others. Redacted too are candidates whose check is all but a
proof (all of these but phones and cards in odd groups), and those whose calibrated chance reaches ``CHANCE``, unless they
overlap a fixed form, which always stays, or a candidate that is proved or has a better chance.

Everything is DataFrame expressions and Spark's own trees. Texts are read once; later
passes see only spans.

Defined results: a null or empty text has no spans; a null doc_id and repeated rows stay as they are, one
result each; ties between overlapping candidates go to the earlier start, then the longer span; without candidates of both labels
the trees add nothing; an empty table
gives no rows; columns named ``base`` or ``spans`` are replaced, other extra columns are kept.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart.llm.registry import query, table
from riskmart.llm.spans import joined, let, matches, of_order, replaced
from riskmart.sources.scratch import Staging, checkpointed

_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$"
KINDS = ["email", "ip", "card", "phone"]

GENERATORS = {
    "contact": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?\(dot\)\x20?|\x20?\[dot\]\x20?)[A-Za-z0-9-]{1,63}+)++",
    "number": r"(?<![0-9])[+(]?[0-9](?:[\x20()./-]{0,2}+[0-9]){6,}+",
    "address": r"(?<![0-9A-Fa-f.:])(?:[0-9]{1,5}(?:\.[0-9]{1,5}){3}|(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?!:?[0-9A-Fa-f]))(?![0-9A-Fa-f])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){10,}+",
}
# Parts of a run that are proposed too: a group, how a first group begins, what does not count, and the counted characters.
PARTS = {
    "number": (r"[+(]?[0-9]+", "^", "[^0-9]", 8, 19),
    "account": (r"[A-Z0-9]+", "^[A-Z]{2}[0-9]{2}", r"\x20", 15, 34),
}
LONGEST_PART = 80  # code points of a part, at most: 34 characters with a space each, 19 digits with separators
AROUND = 24  # code points of context before a candidate
CONTEXT = [
    r"mail|contact|write to|schreib|correo|courriel",
    r"phone|call|tel|fax|mobil|whatsapp|sms",
    r"card|visa|credit|pay|iban|account|konto|tarjeta|carte",
    r"\bip\b|host|server|addr|login|router|dns",
    r"[$%#|=:\"]\W*$",
]
SAMPLE, FOLDS = 20_000, 4
TREES, DEPTH = 10, 3
CHANCE = 0.9
ADDRESS = r"^[A-Za-z0-9_](?:[A-Za-z0-9_%+-]|\.(?!\.))*+(?<!\.)@(?:[A-Za-z0-9]++(?:-++[A-Za-z0-9]++)*+\.)++[A-Za-z]{2,}$"
GROUPS = r"^(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2})$"
IBAN = r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"
CARD_GROUPS = r"^(?:[0-9]{16,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{1,3})?)$"
# National numbers as digits: North America; Great Britain and Germany, France with the trunk zero; Spain.
NATIONAL = r"^(?:1?[2-9][0-9]{2}[2-9][0-9]{6}|0[1-9][0-9]{7,10}|[6-9][0-9]{8}|00[1-9][0-9]{7,12})$"
GROUPED = r"^(?:\(|0[0-9]*[\x20./-]|(?:1[\x20.-])?[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{3,4}$)"
SEED = 7


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def base_spans(text: Column) -> list[Column]:
    """Spans of the fixed forms, one array per kind."""
    def card(s: Column) -> Column:
        number = digits(s["text"])
        return F.char_length(number).between(16, 19) & F.call_function("luhn_check", number)

    return [
        matches(text, EMAIL),
        F.filter(matches(text, IP), lambda s: s["text"].rlike(IP_PARTS)),
        F.filter(matches(text, CARD), card),
        F.filter(matches(text, PHONE), lambda s: F.char_length(digits(s["text"])).between(8, 15)),
    ]


def features(text: Column, span: Column, generator: int) -> Column:
    """Format and context of a candidate as numbers."""
    string = span["text"]
    before = F.lower(F.substring(text, F.greatest(span["start"] - AROUND, F.lit(0)) + 1, F.least(span["start"], F.lit(AROUND))))
    after = F.substring(text, span["end"] + 1, 1)
    groups = F.filter(F.split(string, "[^0-9]+"), lambda g: g != "")
    flags = [
        string.contains("@"), string.startswith("+"), string.contains("("), string.contains(":"),
        before.rlike(r"[\p{L}\p{N}]$"), after.rlike(r"^[\p{L}\p{N}]"),
    ]
    numbers = [
        F.lit(generator), F.char_length(string), F.char_length(digits(string)), F.regexp_count(string, F.lit("[A-Za-z]")),
        F.regexp_count(string, F.lit(r"[\x20]")), F.regexp_count(string, F.lit(r"\.")), F.regexp_count(string, F.lit("-")),
        F.size(groups), F.coalesce(F.array_max(F.transform(groups, lambda g: F.char_length(g))), F.lit(0)),
        *[f.cast("int") for f in flags], *[before.rlike(c).cast("int") for c in CONTEXT],
    ]
    return F.array(*[n.cast("double") for n in numbers])


N_FEATURES = 9 + 6 + len(CONTEXT)


def evidence(span: Column, kind: str, features: Column) -> Column:
    """How far a check of its own confirms a candidate: 2 all but proves it, 1 is a label only, 0 nothing."""
    string = span["text"]
    if kind == "contact":
        plain = F.regexp_replace(F.regexp_replace(string, r"\x20?[(\[]at[)\]]\x20?", "@"), r"\x20?[(\[]dot[)\]]\x20?", ".")
        return F.when(F.regexp_replace(plain, r"\x20", "").rlike(ADDRESS), 2).otherwise(0)
    if kind == "address":
        return F.when(string.rlike(IP_PARTS) | string.rlike(GROUPS), 2).otherwise(0)
    if kind == "account":
        number = F.regexp_replace(string, r"\x20", "")
        return F.when(number.rlike(IBAN), F.when(remainder(number) == 1, 2).otherwise(0)).otherwise(0)
    number = digits(string)
    card = F.char_length(number).between(16, 19) & F.call_function("luhn_check", number) & ~string.rlike(r"[^0-9\x20-]")
    abroad = string.rlike(r"^\+[1-9]") & F.char_length(number).between(8, 15)
    spoken = features[N_FEATURES - len(CONTEXT) + 1] > 0
    national = number.rlike(NATIONAL) & (spoken | string.rlike(GROUPED))
    return F.when(card & string.rlike(CARD_GROUPS), 2).when(card | abroad | national, 1).otherwise(0)


def remainder(account: Column) -> Column:
    """Remainder by 97 of an account number with its first four characters moved to the end and letters as 10 to 35."""
    moved = F.split(F.concat(F.substring(account, 5, 40), F.substring(account, 1, 4)), "")

    def step(rest: Column, c: Column) -> Column:
        value = F.ascii(c)
        return F.when(value < 65, rest * 10 + value - 48).otherwise(rest * 100 + value - 55) % 97

    return F.aggregate(F.filter(moved, lambda c: c != ""), F.lit(0), step)


def parts(text: Column, run: Column, kind: str) -> Column:
    """Groups of a run and neighbouring groups of the wanted size, but not the whole run: (around, span in it, how far it was moved).

    A group's surroundings are cut out once, so a part costs no more in a long run.
    """
    group, begin, uncounted, low, high = PARTS[kind]

    def window(groups: Column) -> Column:
        origin = F.greatest(run["start"] - AROUND, F.lit(0))
        return let(F.substring(text, origin + 1, run["end"] - origin + 1), lambda seen: placed(groups, seen, origin))

    def placed(groups: Column, seen: Column, origin: Column) -> Column:
        def of_first(g: Column, i: Column) -> Column:
            at = run["start"] - origin + g["start"]
            moved = F.greatest(at - AROUND, F.lit(0))
            near = F.struct(
                F.substring(seen, moved + 1, F.lit(AROUND + LONGEST_PART + 1)).alias("around"), (origin + moved).alias("moved"), (at - moved).alias("at")
            )
            return let(near, lambda x: ending(g, i, x))

        def ending(g: Column, i: Column, x: Column) -> Column:
            def span(last: Column) -> Column:
                size = last["end"] - g["start"]
                return F.struct(x["at"].alias("start"), (x["at"] + size).alias("end"), F.substring(x["around"], x["at"] + 1, size).alias("text"))

            near = F.filter(F.slice(groups, i + 1, high), lambda last: last["end"] - g["start"] <= LONGEST_PART)
            near = F.filter(near, lambda last: (g["start"] > 0) | (last["end"] < run["end"] - run["start"]))
            sized = F.filter(F.transform(near, span), lambda s: F.char_length(F.regexp_replace(s["text"], uncounted, "")).between(low, high))
            return F.transform(sized, lambda s: F.struct(x["around"].alias("around"), s.alias("span"), x["moved"].alias("moved")))

        found = F.transform(groups, lambda g, i: F.when(g["text"].rlike(begin), of_first(g, i)))
        return F.flatten(F.filter(found, lambda f: f.isNotNull()))

    return let(matches(run["text"], group), window)


def candidates(text: Column) -> Column:
    """All proposals as (start, end, kind, features, evidence)."""
    def proposed(i: int, kind: str, pattern: str) -> Column:
        def described(around: Column, s: Column, moved: Column) -> Column:
            return let(
                features(around, s, i),
                lambda known: F.struct(
                    (s["start"] + moved).alias("start"), (s["end"] + moved).alias("end"), F.lit(kind).alias("kind"),
                    known.alias("features"), evidence(s, kind, known).alias("evidence"),
                ),
            )

        def every(runs: Column) -> Column:
            whole = F.transform(runs, lambda s: described(text, s, F.lit(0)))
            if kind not in PARTS:
                return whole
            part = lambda p: described(p["around"], p["span"], p["moved"])
            return F.concat(whole, F.transform(F.flatten(F.transform(runs, lambda s: parts(text, s, kind))), part))

        return F.when(F.rlike(text, F.lit(pattern)), let(matches(text, pattern), every))

    none = F.array().cast("array<struct<start:int,end:int,kind:string,features:array<double>,evidence:int>>")
    return F.concat(*[F.coalesce(proposed(i, kind, pattern), none) for i, (kind, pattern) in enumerate(GENERATORS.items())])


def found(docs: DataFrame, staging: Staging, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row with ``base`` and ``candidates``, stored with a row number."""
    kept = [F.col(f"`{c}`") for c in keep if c not in ("base", "spans")]

    def kind(spans: Column, order: int) -> Column:
        return F.transform(
            spans, lambda s: F.struct(F.lit(order).alias("order"), s["start"].alias("start"), s["end"].alias("end"), F.lit(KINDS[order]).alias("kind"))
        )

    body = docs.select(F.struct(*kept).alias("_row"), F.coalesce(F.col("text"), F.lit("")).alias("_body"))
    text = F.col("_body")
    base = F.sort_array(F.concat(*[kind(s, i) for i, s in enumerate(base_spans(text))]))
    # A text without a digit or an at sign has nothing to propose.
    proposals = F.when(text.rlike(r"[0-9@]|(?:\(|\[)at[)\]]"), candidates(text))
    out = body.select("_row", base.alias("base"), proposals.alias("candidates"))
    return staging.table(out.withColumn("_at", F.monotonically_increasing_id()), "spans")


def added_spans(spans: DataFrame) -> DataFrame:
    """``_at`` and the spans that the trees add to each row."""
    overlap = F.exists("base", lambda b: (b["start"] < F.col("c")["end"]) & (F.col("c")["start"] < b["end"]))
    equal = F.exists("base", lambda b: (b["start"] == F.col("c")["start"]) & (F.col("c")["end"] == b["end"]))
    label = F.when(equal | (F.col("c.evidence") > 0), 1.0).when(~overlap, 0.0)
    rows = spans.select("_at", "base", F.explode("candidates").alias("c")).select(
        "_at", "c.start", "c.end", "c.kind", label.alias("label"), overlap.alias("matched"), (F.col("c.evidence") == 2).alias("proved"),
        *[F.col("c.features")[i].alias(f"f{i}") for i in range(N_FEATURES)],
    )
    assemble = VectorAssembler(inputCols=[f"f{i}" for i in range(N_FEATURES)], outputCol="features")
    order = F.xxhash64(F.lit(SEED), "start", "end", "kind", *[f"f{i}" for i in range(N_FEATURES)], "_at")
    picked = rows.filter("label is not null").withColumn("order", order).orderBy("order", "_at").limit(SAMPLE)
    # The sample is bounded, and so is a label's share of it.
    fold = (F.row_number().over(W.partitionBy("label").orderBy("order", "_at")) - 1) % FOLDS
    sample = checkpointed(assemble.transform(picked.withColumn("fold", fold)).select("features", "label", "fold").coalesce(1))
    proved = rows.filter("proved and not matched").select("_at", "start", "end", "kind", F.lit(2.0).alias("score"))
    if sample.select("label").distinct().count() < 2:
        return _chosen(proved)
    score = vector_to_array("probability")[1].alias("score")
    calibration = IsotonicRegression(featuresCol="score").fit(_held_out_scores(sample, score))
    trees = _trees(sample)
    open_rows = assemble.transform(rows.filter("not matched and not proved"))
    scored = calibration.transform(trees.transform(open_rows).select("_at", "start", "end", "kind", score))
    return _chosen(proved.unionByName(scored.filter(F.col("prediction") >= CHANCE).drop("prediction")))


def _trees(sample: DataFrame):
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED).fit(sample)


def _held_out_scores(sample: DataFrame, score: Column) -> DataFrame:
    """``label, score`` of every row by trees that have not seen its fold; without both labels to learn from, the score is the one there is."""
    sizes = {(r["fold"], r["label"]): r["count"] for r in sample.groupBy("fold", "label").count().collect()}
    parts = []
    for fold in sorted({f for f, _ in sizes}):
        labels = {label for f, label in sizes if f != fold}
        held, rest = sample.filter(F.col("fold") == fold), sample.filter(F.col("fold") != fold)
        known = F.lit(sum(labels) / len(labels) if labels else 0.5)
        parts.append(_trees(rest).transform(held).select("label", score) if len(labels) == 2 else held.select("label", known.alias("score")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def _chosen(spans: DataFrame) -> DataFrame:
    """``_at`` and the spans of each row without overlaps, the best score first."""
    best_first = F.sort_array(F.collect_list(F.struct(F.negate("score").alias("score"), "start", F.negate("end").alias("till"), "kind")))
    return spans.groupBy("_at").agg(best_first.alias("c")).select("_at", _without_overlaps(F.col("c")).alias("added"))


def _without_overlaps(best_first: Column) -> Column:
    """The candidates that overlap none before them, as spans."""
    def take(chosen: Column, c: Column) -> Column:
        span = F.struct(F.lit(len(KINDS)).alias("order"), c["start"].alias("start"), F.negate(c["till"]).alias("end"), c["kind"].alias("kind"))
        free = ~F.exists(chosen, lambda s: (s["start"] < F.negate(c["till"])) & (c["start"] < s["end"]))
        return F.when(free, F.concat(chosen, F.array(span))).otherwise(chosen)

    return F.aggregate(best_first, F.array().cast("array<struct<order:int,start:int,end:int,kind:string>>"), take)


def with_spans(docs: DataFrame, staging: Staging, keep: list[str] | None = None) -> DataFrame:
    """Every row with ``base`` and ``spans``, arrays of (order, start, end, kind) by kind, then start."""
    spans = found(docs, staging, keep or docs.columns)
    joined_rows = spans.drop("candidates").join(added_spans(spans), "_at", "left")
    every = F.sort_array(F.concat("base", F.coalesce("added", F.array().cast("array<struct<order:int,start:int,end:int,kind:string>>"))))
    return joined_rows.select("_row.*", "base", every.alias("spans"))


def redacted(docs: DataFrame, staging: Staging, label: str = "[PII]") -> DataFrame:
    """The documents with every span replaced by a label."""
    by_start = F.sort_array(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    out = with_spans(docs.select(row, "text"), staging)
    out = out.select("row", F.when(F.col("text").isNotNull(), replaced(F.col("text"), by_start, label)).alias("text"))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    return out.select(*[value.alias(c) for c, value in columns.items()])


@query("op4_pii")
def op4_pii(spark, sf_dir):
    docs = with_spans(table(spark, sf_dir, "documents"), Staging(spark), ["doc_id"])
    count = [F.size(of_order(F.col("base"), i)).cast("long").alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return docs.select("doc_id", *count, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
