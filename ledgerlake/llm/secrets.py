"""Secret scan with multipart credential linking (DataFrame functions only).

Strong spans (``assign``, ``access``, ``hex``) stand on their own.  Weak
candidates (an account name, a bare high-entropy string, an endpoint) say
little alone; each is reported only when its complementary parts lie within
``window`` code points in the same scope (a block of text between blank
lines): an identifier needs a secret, a bare secret needs an identifier, an
endpoint needs both.  The co-occurrence test is an interval join on
(row, scope, class, position bucket).

Defined cases: NULL text counts as empty; a NULL id is kept; repeated rows
each get their result; an empty table gives an empty result; columns other
than the id and the text are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: FIXED VALUES: strong patterns as (kind, prefix group, value group, least length of the value).
STRONG = [
    ("assign", r"((?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)",
     r"([A-Za-z0-9+/_.=-]+)", 6),
    ("access", r"()", r"(AKIA[A-Z0-9]{16,})", 20),
    ("hex", r"()", r"([0-9a-f]{24,})", 24),
]
#: Weak candidates: (kind, prefix group, value group, least length, class of the part).
WEAK = [
    ("id", r"((?i:access_?key_?id|client_?id|account_?id|user_?name|login)[\"']?\x20*[:=]\x20*[\"']?)",
     r"([A-Za-z0-9@._+-]{3,})", 3, "id"),
    ("id", r"()", r"((?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{8,})", 12, "id"),
    ("key", r"()", r"((?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_-]{20})(?=[A-Za-z0-9+/_-]*[0-9])"
                   r"(?=[A-Za-z0-9+/_-]*[a-z])(?=[A-Za-z0-9+/_-]*[A-Z])[A-Za-z0-9+/_-]{20,}={0,2})", 20, "secret"),
    ("endpoint", r"()", r"((?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3a?)"
                        r"://[^\x00-\x20\"'<>]{3,})", 3, "endpoint"),
]
KINDS = ["assign", "access", "hex", "id", "key", "endpoint"]
_STRONG_CLASS = {"assign": "secret", "access": "id", "hex": "secret"}
_NEEDS = {"id": ["secret"], "key": ["id"], "endpoint": ["id", "secret"]}
_BREAK = (r"()", r"(\n[\x20\t\r]*\n)")
_MARK, _SAFE = "\u0001", "\u0002"
_SPAN = "struct<start:int,rank:int,end:int>"


def find_spans(text: Column, prefix: str, value: str, least: int, rank: int) -> Column:
    """Leftmost non-overlapping matches of ``prefix + value`` as an array of
    (start, rank, end) in code points, those with a shorter value left out.

    The matches are fenced by a control character (which no pattern can
    match), the text is split at the fences, and one fold over the pieces
    adds up their lengths.
    """
    fenced = F.regexp_replace(F.translate(text, _MARK, _SAFE), F.lit(prefix + value),
                              F.lit(f"{_MARK}$1{_MARK}$2{_MARK}"))
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("start"), F.lit(0).alias("pos"),
                    F.array().cast(f"array<{_SPAN}>").alias("out"))

    def step(acc, piece):
        size = F.length(piece)
        span = F.struct(acc["start"].alias("start"), F.lit(rank).alias("rank"),
                        (acc["pos"] + size).alias("end"))
        return F.struct(
            ((acc["i"] + 1) % 3).alias("i"),
            F.when(acc["i"] == 1, acc["pos"]).otherwise(acc["start"]).alias("start"),
            (acc["pos"] + size).alias("pos"),
            F.when((acc["i"] == 2) & (size >= least), F.array_append(acc["out"], span))
             .otherwise(acc["out"]).alias("out"))

    found = F.aggregate(F.split(fenced, _MARK, -1), zero, step, lambda acc: acc["out"])
    return F.when(text.rlike(prefix + value), found).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _clear_of(spans: Column, taken: Column) -> Column:
    """Spans that overlap none of ``taken``."""
    return F.filter(spans, lambda s: ~F.exists(
        taken, lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"])))


def _classed(spans: Column, cls: str, weak: bool) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"),
        F.lit(cls).alias("cls"), F.lit(weak).alias("weak")))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 window: int = 200) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key (hash of id and text),
    base and spans, both array<(start, rank, end)> sorted by start then rank;
    ``rank`` indexes ``KINDS`` and ``spans`` holds base and linked spans."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    strong = {k: find_spans(text, pre, val, least, KINDS.index(k)) for k, pre, val, least in STRONG}
    weak = [find_spans(text, pre, val, least, KINDS.index(k)) for k, pre, val, least, _ in WEAK]
    found = rows.select(
        "doc_id", F.xxhash64("doc_id", "text").alias("text_key"),
        *[c.alias(f"_s_{k}") for k, c in strong.items()],
        *[c.alias(f"_w_{i}") for i, c in enumerate(weak)],
        find_spans(text, *_BREAK, 2, 0).alias("_breaks"))
    base = F.sort_array(F.concat(*[F.col(f"_s_{k}") for k in strong]))
    found = found.withColumn("base", base)
    parts = F.concat(*[_classed(F.col(f"_s_{k}"), _STRONG_CLASS[k], False) for k in strong],
                     *[_classed(_clear_of(F.col(f"_w_{i}"), F.col("base")), WEAK[i][4], True)
                       for i in range(len(WEAK))])
    scoped = F.transform(F.col("_parts"), lambda p: F.struct(
        p["start"].alias("start"), p["rank"].alias("rank"), p["end"].alias("end"),
        p["cls"].alias("cls"), p["weak"].alias("weak"),
        F.size(F.filter(F.col("_breaks"), lambda b: b["start"] < p["start"])).alias("scope")))
    has_weak = F.exists(parts, lambda p: p["weak"])
    narrow = cut(found.withColumn("_parts", F.when(has_weak, parts))
                      .select("doc_id", "text_key", "base",
                              F.when(F.col("_parts").isNotNull(), scoped).alias("parts")))
    linked = link_parts(narrow.filter(F.col("parts").isNotNull())
                              .select("text_key", F.explode("parts").alias("p"))
                              .select("text_key", "p.*").distinct(), window)
    plain = narrow.filter(F.col("parts").isNull()).select("doc_id", "text_key", "base",
                                                         F.col("base").alias("spans"))
    joined = (narrow.filter(F.col("parts").isNotNull()).join(linked, "text_key", "left")
                    .select("doc_id", "text_key", "base",
                            F.sort_array(F.concat("base", F.coalesce(
                                "linked", F.array().cast(f"array<{_SPAN}>")))).alias("spans")))
    return plain.unionByName(joined)


def link_parts(parts: DataFrame, window: int) -> DataFrame:
    """Interval join: weak parts all of whose complements co-occur, as
    text_key and ``linked`` (array of spans).

    A probe covers the buckets its span reaches with the window added, a
    part those it lies in, so both sides of a key are bounded by the bucket
    width and no hot text meets itself as a whole.
    """
    needs = F.create_map(*[x for k, v in _NEEDS.items()
                           for x in (F.lit(KINDS.index(k)), F.array(*map(F.lit, v)))])
    probe = (parts.filter("weak").withColumn("needs", needs[F.col("rank")])
                  .withColumn("n_needs", F.size("needs")).withColumn("cls", F.explode("needs"))
                  .withColumn("bucket", F.explode(F.sequence(
                      F.floor((F.col("start") - window) / window), F.floor((F.col("end") + window) / window)))))
    build = (parts.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("start") / window),
                                                             F.floor(F.col("end") / window))))
                  .select("text_key", "scope", "cls", "bucket", F.col("start").alias("b_start"),
                          F.col("end").alias("b_end")))
    near = probe.join(build, (probe["text_key"] == build["text_key"]) & (probe["scope"] == build["scope"])
                      & (probe["cls"] == build["cls"]) & (probe["bucket"] == build["bucket"])
                      & (F.col("b_start") <= F.col("end") + window)
                      & (F.col("b_end") >= F.col("start") - window), "left_semi")
    met = (near.groupBy("text_key", "start", "rank", "end", "n_needs")
               .agg(F.collect_set("cls").alias("met")).filter(F.size("met") == F.col("n_needs")))
    return met.groupBy("text_key").agg(F.collect_set(F.struct("start", "rank", "end")).alias("linked"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """Text with every (merged) span replaced by ``mask``."""
    zero = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"])
        return (F.when(s["start"] >= acc["pos"], F.struct(
                    s["end"].alias("pos"), F.concat(acc["out"], gap, F.lit(mask)).alias("out")))
                 .otherwise(F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), acc["out"].alias("out"))))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, zero, step,
        lambda acc: F.concat(acc["out"], F.substring(text, acc["pos"] + 1, F.length(text)))))


def redact_documents(docs: DataFrame, mask: str = "[SECRET]", window: int = 200) -> DataFrame:
    """``docs`` with every found span masked and n_chars counted anew; all
    rows stay.  Only rows that hold some candidate meet the found spans."""
    any_part = "|".join(f"(?:{pre}{val})" for pre, val in
                        [(p, v) for _, p, v, _ in STRONG] + [(p, v) for _, p, v, _, _ in WEAK])
    touched = F.coalesce(F.col("text").rlike(any_part), F.lit(False))
    some = docs.filter(touched)
    found = (scan_secrets(some, window=window).filter(F.size("spans") > 0)
             .groupBy("text_key").agg(F.first("spans").alias("_spans")).withColumnRenamed("text_key", "_key"))
    spans = F.coalesce("_spans", F.array().cast(f"array<{_SPAN}>"))
    masked = (some.join(found, F.xxhash64(F.col("doc_id"), F.col("text").cast("string")) == F.col("_key"), "left")
                  .withColumn("text", redact(F.col("text"), spans, mask)).select(*docs.columns))
    out = docs.filter(~touched).unionByName(masked)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
