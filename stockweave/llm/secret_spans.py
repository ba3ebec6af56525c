"""Secrets in texts: fixed patterns, and strings of high entropy in a sliding window.

Built-in expressions only. A text is searched inside its row; nothing is
shuffled. Positions come from the pieces between matches: ``split`` and
``regexp_extract_all`` walk a text in the same way, so match k ends where the
first k pieces and matches together end. Positions are code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.llm.arrays import block_sums, running_sums

# The base patterns, in the order their kinds are listed.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST = 8

# Candidates of the entropy search: one window at least of the alphabet's letters.
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Bits per character that a window must reach, by the class of the candidate.
CLASSES = (
    ("entropy_hex", r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+$", 2.9),
    ("entropy_alnum", r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9]+$", 3.7),
    ("entropy_base64", r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])", 3.8),
)
KINDS = ("assign", "access", "hex", *(name for name, _, _ in CLASSES))
# Not secrets: identifiers and fingerprints that are public by nature, and examples.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
    r"|(?i)example|placeholder|0123456789|abcdefghij"
)
ALLOWED_BEFORE = r"(?i)(?:sha-?(?:1|224|256|384|512)|md5|commit|checksum|integrity)[\x20:=\"'-]{0,3}$"
CONTEXT = 24


def _placed(df: DataFrame, text: str, name: str, pattern: str, group: int | None) -> DataFrame:
    """Adds ``name``: the matches as structs of start, end, match, group and the text before.

    Texts without a match are left out of the work by the tests around it.
    """
    found = F.col(text).rlike(pattern)
    none = F.array().cast("array<string>")
    p = F.lit(pattern)
    df = df.withColumns(
        {
            f"{name}_m": F.when(found, F.regexp_extract_all(text, p, F.lit(0))).otherwise(none),
            f"{name}_g": F.when(
                found, F.regexp_extract_all(text, p, F.lit(group or 0))
            ).otherwise(none),
            f"{name}_p": F.when(found, F.split(text, pattern, -1)).otherwise(none),
        }
    )
    length = F.zip_with(
        f"{name}_m",
        F.slice(f"{name}_p", 1, F.size(f"{name}_m")),
        lambda m, piece: (F.char_length(m) + F.char_length(piece)).cast("long"),
    )
    df = df.withColumn(f"{name}_b", block_sums(length))
    parts = F.arrays_zip(
        running_sums(F.col(f"{name}_b")).alias("end"),
        F.col(f"{name}_m").alias("match"),
        F.col(f"{name}_g").alias("group"),
        F.slice(f"{name}_p", 1, F.size(f"{name}_m")).alias("piece"),
    )
    spans = F.transform(
        parts,
        lambda x: F.struct(
            (x["end"] - F.char_length(x["match"])).alias("start"),
            x["end"].alias("end"),
            x["match"].alias("match"),
            x["group"].alias("group"),
            F.right(x["piece"], F.lit(CONTEXT)).alias("before"),
        ),
    )
    return df.withColumn(name, F.when(F.size(f"{name}_m") > 0, spans).otherwise(F.array().cast(
        "array<struct<start:bigint,end:bigint,match:string,group:string,before:string>>"
    ))).drop(*[f"{name}_{x}" for x in "mgpb"])


def _spans(matches: Column, kind: str | Column, order: int | Column) -> Column:
    """Matches as (start, order, kind, end), so that sorting is by start, then kind as listed."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    order = F.lit(order) if isinstance(order, int) else order
    return F.transform(
        matches,
        lambda x: F.struct(
            x["start"].alias("start"), order.alias("order"), kind.alias("kind"), x["end"].alias("end")
        ),
    )


def _weight(count: Column) -> Column:
    """count * log2(count), 0 at 0."""
    return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))


def hot_stretch(candidate: Column, least: Column) -> Column:
    """(first, last): from the first to the last window whose entropy reaches ``least``.

    One pass with the counts of the letters in the window: a step adds one
    letter, drops the one that leaves, and corrects the sum of c log2 c for
    these two. The entropy of the window is log2(window) - sum / window.
    """
    letters = F.transform(
        F.split(candidate, ""), lambda c: F.instr(F.lit(ALPHABET), c)
    )
    leaving = F.concat(F.array_repeat(F.lit(0), WINDOW), letters)
    steps = F.filter(
        F.zip_with(letters, leaving, lambda a, b: F.struct(a.alias("add"), b.alias("drop"))),
        lambda s: s["add"].isNotNull(),
    )
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(0).alias("at"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )

    def moved(state: Column, step: Column) -> Column:
        add, drop = step["add"], step["drop"]
        same = add == drop
        up = F.get(state["counts"], add - 1)
        down = F.when(drop > 0, F.get(state["counts"], drop - 1))
        change = F.when(same, F.lit(0.0)).otherwise(
            _weight(up + 1) - _weight(up)
            + F.coalesce(_weight(down - 1) - _weight(down), F.lit(0.0))
        )
        counts = F.transform(
            state["counts"],
            lambda c, i: c + (i == add - 1).cast("int") - (i == drop - 1).cast("int"),
        )
        return F.struct(
            counts.alias("counts"),
            (state["sum"] + change).alias("sum"),
            (state["at"] + 1).alias("at"),
            state["first"].alias("first"),
            state["last"].alias("last"),
        )

    def noted(state: Column) -> Column:
        entropy = F.log2(F.lit(float(WINDOW))) - state["sum"] / WINDOW
        hot = (state["at"] >= WINDOW) & (entropy >= least)
        return F.struct(
            state["counts"].alias("counts"),
            state["sum"].alias("sum"),
            state["at"].alias("at"),
            F.when(hot, F.coalesce(state["first"], state["at"] - WINDOW))
            .otherwise(state["first"])
            .alias("first"),
            F.when(hot, state["at"]).otherwise(state["last"]).alias("last"),
        )

    # transform() of a one-element array binds the moved state, which is then read several times.
    def step(state: Column, s: Column) -> Column:
        return F.get(F.transform(F.array(moved(state, s)), noted), F.lit(0))

    return F.aggregate(
        steps, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"))
    )


def _entropy_spans(found: Column) -> Column:
    """Spans of the candidates with a hot stretch that the allow-list does not excuse."""

    def chosen(x: Column, values: list) -> Column:
        out = F.lit(None)
        for (_, pattern, _), value in reversed(list(zip(CLASSES, values))):
            out = F.when(x["match"].rlike(pattern), F.lit(value)).otherwise(out)
        return out

    usable = F.filter(
        found,
        lambda x: chosen(x, [True] * len(CLASSES)).isNotNull()
        & ~x["match"].rlike(ALLOWED)
        & ~x["before"].rlike(ALLOWED_BEFORE),
    )
    measured = F.transform(
        usable,
        lambda x: F.struct(
            x["start"].alias("start"),
            hot_stretch(x["match"], chosen(x, [bits for _, _, bits in CLASSES])).alias("hot"),
            chosen(x, list(range(len(CLASSES)))).alias("k"),
        ),
    )
    names = F.array(*[F.lit(name) for name, _, _ in CLASSES])
    return F.transform(
        F.filter(measured, lambda x: x["hot"]["first"].isNotNull()),
        lambda x: F.struct(
            (x["start"] + x["hot"]["first"]).alias("start"),
            (x["k"] + 3).alias("order"),
            F.get(names, x["k"]).alias("kind"),
            (x["start"] + x["hot"]["last"]).alias("end"),
        ),
    )


SPAN_TYPE = "array<struct<start:bigint,order:int,kind:string,end:bigint>>"


def find(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (default: all, as struct ``row``) with ``base`` and ``all_spans``.

    Both are arrays of (start, order, kind, end) sorted by start, then kind as
    listed in ``KINDS``; ``text`` is the text, empty for NULL. ``base`` holds the
    matches of the fixed patterns (the whole match, the assigned value of 8 or
    more characters); ``all_spans`` also the high-entropy ones. Repeated rows
    give repeated rows, an empty table an empty one.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in carry] if carry is not None else ["*"]
    df = docs.select(F.struct(*kept).alias("row"), text.alias("text"))
    for name, pattern, group in (
        ("m_assign", ASSIGN, 2),
        ("m_access", ACCESS, None),
        ("m_hex", HEX, None),
        ("m_candidate", CANDIDATE, None),
    ):
        df = _placed(df, "text", name, pattern, group)
    assign = F.filter("m_assign", lambda x: F.char_length(x["group"]) >= ASSIGN_LEAST)
    base = F.concat(
        _spans(assign, "assign", 0),
        _spans(F.col("m_access"), "access", 1),
        _spans(F.col("m_hex"), "hex", 2),
    ).cast(SPAN_TYPE)
    more = F.when(
        F.size("m_candidate") > 0, _entropy_spans(F.col("m_candidate")).cast(SPAN_TYPE)
    ).otherwise(F.array().cast(SPAN_TYPE))
    df = df.select("row", "text", F.array_sort(base).alias("base"), more.alias("more"))
    return df.select("row", "text", "base", F.array_sort(F.concat("base", "more")).alias("all_spans"))


def spans_text(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
        ),
        ",",
    )


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """All columns of ``docs`` with every span replaced by ``mask`` in the text.

    Overlapping spans become one. Texts without a span, NULL included, are left
    as they are, and no row is dropped.
    """
    found = find(docs, text_col)
    zero = F.lit(0).cast("long")
    merged = F.aggregate(
        "all_spans",
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, x: F.when(
            F.coalesce(F.try_element_at(acc, F.lit(-1))["end"] >= x["start"], F.lit(False)),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.element_at(acc, -1)["start"].alias("start"),
                        F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(
            F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))
        ),
    )
    ends = F.concat(
        F.array(zero), F.transform("merged", lambda x: x["end"])
    )
    starts = F.concat(
        F.transform("merged", lambda x: x["start"]), F.array(F.char_length("text").cast("long"))
    )
    text = F.col("text")
    pieces = F.zip_with(
        ends, starts, lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    )
    clean = F.when(F.size("all_spans") > 0, F.array_join(pieces, mask)).otherwise(
        F.col(f"row.`{text_col}`").cast("string")
    )
    marked = found.withColumn("merged", merged)
    return marked.select(
        *[
            clean.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c)
            for c in docs.columns
        ]
    )
