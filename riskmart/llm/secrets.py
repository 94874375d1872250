"""Secret scans: fixed forms, and sliding-window Shannon entropy over candidate strings.

Candidates are runs of at least a window of letters, digits and ``+/_=-`` that hold a digit or change case. A
window of 20 characters slides over each; counts of its characters are kept incrementally: one
count goes up, one goes down, and the sum of n log n changes by these two alone. Windows at or above the threshold
of the string's character class (hex digits, letters with digits, letters) make a span from the first such window to
the last. Allow-listed strings (UUIDs, numbers, repeated short patterns, paths of plain words) are left alone, and so are spans all
of whose parts between separators are placeholders. A span of entropy is cut at the ends of a fixed form's; those always stay.

Everything is DataFrame expressions on one row at a time: no shuffle at all.

Defined results: a null or empty text has no spans; a null doc_id and repeated rows stay as they are;
spans count code points, the end exclusive; an empty table gives no rows; extra columns are kept by ``redacted``
and not read otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.registry import query, table
from riskmart.llm.spans import joined, let, matches, named, of_order, replaced

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
SECRET_CHARS = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
WINDOW = 20
_RUN = "[A-Za-z0-9+/_=-]"
CANDIDATE = rf"(?<!{_RUN})(?=[A-Za-z+/_=-]*+[0-9]|{_RUN}*?[a-z][A-Z]){_RUN}{{{WINDOW},}}"
# Bits per character; 20 different characters have 4.32.
THRESHOLDS = {"hex": 3.0, "mixed": 3.7, "letters": 4.0}
ALLOWED = [
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
    r"^[0-9+/_=-]+$",  # numbers
    r"^(.{1,8})\1+$",  # one short pattern again and again
    r"^/?(?:[A-Za-z]+[/_=-]+)+[A-Za-z]*[0-9]{0,4}$",  # plain words in a path or a name
]
_FILLER = "example|sample|placeholder|dummy|changeme|redacted|xxxx|0000|1234567"
_PART = "(?:[a-z]{0,12}+1234567[0-9]{0,3}+|[a-z]{0,12}+0{4,}+|[a-z]{1,24}+[0-9]{0,4}+)"
# Words and fillers alone, with a filler among them; longer strings are none.
PLACEHOLDER = rf"(?i)^(?=.{{0,128}}(?:{_FILLER}))[+/_=-]*+{_PART}(?:[+/_=-]++{_PART})*+[+/_=-]*+$"
KINDS = ["assign", "access", "hex", "entropy"]
LABEL = "[SECRET]"


def base_spans(text: Column) -> list[Column]:
    """Spans of the fixed forms, one array per kind."""
    assign = F.filter(matches(text, ASSIGN, 1), lambda s: F.char_length(s["part"]) >= SECRET_CHARS)
    return [assign, matches(text, ACCESS), matches(text, HEX)]


def character_class(string: Column) -> Column:
    return (
        F.when(string.rlike("^[0-9a-fA-F]+$"), "hex").when(string.rlike("[0-9]"), "mixed").otherwise("letters")
    )


def entropy_range(string: Column, threshold: Column) -> Column:
    """(first, last) start of a window whose entropy reaches ``threshold``; first is null without one."""
    letters_and_codes = let(
        F.split(string, ""),
        lambda chars: let(
            F.array_distinct(chars),
            # Characters as places in the string's own alphabet.
            lambda letters: F.struct(
                F.size(letters).alias("n"),
                F.transform(chars, lambda c: F.array_position(letters, c).cast("int") - 1).alias("codes"),
                threshold.alias("threshold"),
            ),
        ),
    )

    def term(n: Column) -> Column:
        return F.when(n > 1, n * F.log2(n)).otherwise(F.lit(0.0))

    def slide(string: Column, state: Column, code: Column) -> Column:
        out = F.when(state["i"] >= WINDOW, F.get(string["codes"], state["i"] - WINDOW)).otherwise(F.lit(-1))

        def counted(x: Column) -> Column:
            """The counts of the character that leaves and of the one that enters, which may be the same."""
            gone = F.get(state["counts"], x)
            return F.struct(
                x.alias("out"), gone.alias("gone"), (F.get(state["counts"], code) - F.when(x == code, 1).otherwise(0)).alias("come")
            )

        def summed(x: Column) -> Column:
            leaves = F.when(x["out"] >= 0, term(x["gone"] - 1) - term(x["gone"])).otherwise(0.0)
            total = state["sum"] + leaves + term(x["come"] + 1) - term(x["come"])
            return F.struct(x["out"].alias("out"), total.alias("sum"))

        def moved(x: Column) -> Column:
            entropy = F.log2(F.lit(float(WINDOW))) - x["sum"] / WINDOW
            hit = (state["i"] >= WINDOW - 1) & (entropy >= string["threshold"])
            start = state["i"] - WINDOW + 1
            change = lambda n, k: n + F.when(k == code, 1).otherwise(0) - F.when(k == x["out"], 1).otherwise(0)
            return F.struct(
                (state["i"] + 1).alias("i"),
                F.transform(state["counts"], change).alias("counts"),
                x["sum"].alias("sum"),
                F.when(hit, F.coalesce(state["first"], start)).otherwise(state["first"]).alias("first"),
                F.when(hit, start).otherwise(state["last"]).alias("last"),
            )

        return let(let(let(out, counted), summed), moved)

    nothing = F.lit(None).cast("int")

    def scan(x: Column) -> Column:
        # Characters seen, counts in the window, its sum of n log2 n, first and last start.
        empty = F.struct(
            F.lit(0).alias("i"), F.array_repeat(F.lit(0), x["n"]).alias("counts"),
            F.lit(0.0).alias("sum"), nothing.alias("first"), nothing.alias("last"),
        )
        return F.aggregate(x["codes"], empty, lambda state, code: slide(x, state, code), lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))

    return let(letters_and_codes, scan)


def allowed(string: Column) -> Column:
    listed = F.lit(False)
    for pattern in ALLOWED:
        listed = listed | string.rlike(pattern)
    return listed


def entropy_spans(text: Column) -> Column:
    """Spans of high entropy in all candidate strings of a text."""
    def measured(s: Column) -> Column:
        kind = character_class(s["text"])
        threshold = F.when(kind == "hex", THRESHOLDS["hex"]).when(kind == "mixed", THRESHOLDS["mixed"]).otherwise(THRESHOLDS["letters"])
        return F.struct(s["start"].alias("at"), s["text"].alias("text"), entropy_range(s["text"], threshold).alias("range"))

    def placeholder(s: Column) -> Column:
        """Whether the parts that hold the windows are words and fillers alone."""
        first, end = s["range"]["first"], s["range"]["last"] + WINDOW
        left = F.regexp_extract(F.substring(s["text"], F.lit(1), first), "[^+/_=-]*+$", 0)
        right = F.regexp_extract(F.substring(s["text"], end + 1, F.char_length(s["text"])), "^[^+/_=-]*+", 0)
        return F.concat(left, F.substring(s["text"], first + 1, end - first), right).rlike(PLACEHOLDER)

    strings = F.filter(matches(text, CANDIDATE), lambda s: ~allowed(s["text"]))
    found = F.filter(F.transform(strings, measured), lambda s: s["range"]["first"].isNotNull() & ~placeholder(s))
    return F.transform(
        found,
        lambda s: F.struct((s["at"] + s["range"]["first"]).alias("start"), (s["at"] + s["range"]["last"] + WINDOW).alias("end")),
    )


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``, arrays of (start, order, end, kind) in order."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("base", "spans")]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    by_kind = [named(s, KINDS[i], i) for i, s in enumerate(base_spans(F.col("_body")))]
    found = docs.select(*kept, body.alias("_body")).select(*kept, F.sort_array(F.concat(*by_kind)).alias("base"), "_body")
    added = named(F.flatten(F.transform(entropy_spans(F.col("_body")), lambda s: _cut(F.col("_body"), s))), KINDS[3], 3)
    return found.select(*kept, "base", F.sort_array(F.concat("base", added)).alias("spans"))


def _cut(text: Column, span: Column) -> Column:
    """What is left of a span between the fixed forms, where it holds a letter or digit."""
    touching = F.filter("base", lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
    kind = "array<struct<start:int,end:int>>"

    def pieces(forms: Column) -> Column:
        def step(state: Column, b: Column) -> Column:
            piece = F.array(F.struct(state["at"].alias("start"), b["start"].alias("end")))
            out = F.when(b["start"] > state["at"], F.concat(state["out"], piece)).otherwise(state["out"])
            return F.struct(F.greatest(state["at"], b["end"]).alias("at"), out.alias("out"))

        end = F.struct(span["end"].alias("start"), span["end"].alias("end"))
        closed = F.concat(F.transform(forms, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))), F.array(end))
        start = F.struct(span["start"].alias("at"), F.array().cast(kind).alias("out"))
        return F.aggregate(closed, start, step, lambda state: state["out"])

    left = F.filter(pieces(touching), lambda p: F.substring(text, p["start"] + 1, p["end"] - p["start"]).rlike("[A-Za-z0-9]"))
    return F.when(F.size(touching) > 0, left).otherwise(F.array(F.struct(span["start"].alias("start"), span["end"].alias("end"))))


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every secret replaced by a label, and ``n_chars``, if there is one, to match."""
    out = with_spans(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text"))
    text = F.when(F.col("text").isNotNull(), replaced(F.col("text"), F.col("spans"), LABEL))
    out = out.select("row", text.alias("text"))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("text").cast("long")
    return out.select(*[value.alias(c) for c, value in columns.items()])


@query("op8_secrets")
def op8_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = with_spans(docs)
    count = [F.size(of_order(F.col("base"), i)).cast("long") for i in range(3)]
    return docs.select(
        "doc_id", *[n.alias(f"n_{kind}") for n, kind in zip(count, KINDS)], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
