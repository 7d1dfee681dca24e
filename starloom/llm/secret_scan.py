"""Secrets in texts, in DataFrame functions only: three fixed patterns, and strings of high local entropy.

The method: candidate strings are runs of token characters.  A candidate's character class is hex, base36 (one case of
letters with digits) or base64 (both cases with digits); a window of ``WINDOW`` characters slides over it, the counts
of its characters are changed by the character that enters and the one that leaves, and with them the Shannon entropy.
The candidate is a secret if some window reaches the class's threshold, unless the allow-list knows it or a pattern
has already reported the place.

Regex functions give what matched and not where; the place follows from the pieces between the matches.  All positions
are code points, ends exclusive.

Defined cases: a null text is empty and has no spans; equal rows get equal results; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import let

#: kind -> pattern, least length, group that the length is asked of.  Fixed values; their order is the order of kinds.
PATTERNS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    "access": (r"AKIA[A-Z0-9]+", 20, 0),
    "hex": (r"[0-9a-f]{24,}", 24, 0),
}
ENTROPY = "entropy"
KINDS = (*PATTERNS, ENTROPY)
WINDOW = 20
#: Matches whose places are added up at a time.
BLOCK = 128
#: Runs as long as the window at least.
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: Class -> pattern of the whole candidate, characters it must all have, bits that a window must reach.
CLASSES = {
    "hex": (r"^[0-9A-F]+$|^[0-9a-f]+$", ("[0-9]", "[A-Fa-f]"), 3.05),
    "base36": (r"^[0-9A-Z+/_=-]+$|^[0-9a-z+/_=-]+$", ("[0-9]", "[A-Za-z]"), 3.45),
    "base64": (r"^[A-Za-z0-9+/_=-]+$", ("[0-9]", "[A-Z]", "[a-z]"), 3.75),
}
#: Strings known to be no secrets: UUIDs, digests named as such, examples, runs of the alphabet or of digits.
ALLOWED = r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$|^(md5|sha1|sha256|sha384|sha512)[-=_]|example|placeholder|xxxx|0123456789|abcdefghij"


def _ends(steps: Column) -> Column:
    """Running totals of an array of integers.

    Totals of blocks first, then within each block: appending to an array per item would copy it each time.
    """
    none = F.array().cast("array<int>")

    def total(part):
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def within(offsets):
        return F.transform(steps, lambda x, i: F.get(offsets, F.floor(i / BLOCK).cast("int")) + total(F.slice(steps, i - i % BLOCK + 1, i % BLOCK + 1)))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")), lambda b: total(F.slice(steps, b * BLOCK + 1, BLOCK)))
    begin = F.struct(F.lit(0).alias("at"), none.alias("all"))
    offsets = F.aggregate(blocks, begin, lambda s, x: F.struct((s.at + x).alias("at"), F.concat(s.all, F.array(s.at)).alias("all")))
    return F.when(F.size(steps) == 0, none).otherwise(let(offsets, lambda o: within(o.all)))


def _places(text: Column, pattern: str, kind: int) -> Column:
    """Array of (start, kind, end) of the leftmost matches that don't overlap."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)

    def spans(matches, pieces):
        steps = F.transform(matches, lambda m, i: F.length(F.get(pieces, i)) + F.length(m))

        def placed(ends):
            return F.transform(matches, lambda m, i: F.struct((F.get(ends, i) - F.length(m)).alias("start"), F.lit(kind).alias("kind"), F.get(ends, i).alias("end")))

        return let(steps, lambda s: let(_ends(s), placed))

    return let(found, lambda m: let(between, lambda p: spans(m, p)))


def _matches(text: Column, kind: str) -> Column:
    pattern, least, group = PATTERNS[kind]
    spans = _places(text, pattern, KINDS.index(kind))
    if least and kind != "hex":  # the hex pattern has the length inside: a run is found whole or not at all
        sizes = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        spans = let(sizes, lambda g: F.filter(spans, lambda s, i: F.length(F.get(g, i)) >= least))
    return _if_any(text, pattern, spans)


def _if_any(text: Column, pattern: str, spans: Column) -> Column:
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def window_entropy(candidate: Column) -> Column:
    """Largest Shannon entropy, in bits, of the windows of a string of ASCII characters."""
    terms = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 1)])
    chars = F.transform(F.split(candidate, ""), lambda c: F.ascii(c))

    def slide(codes, table):
        def step(state, j):
            enters, leaves = F.get(codes, j), F.coalesce(F.get(codes, j - WINDOW), F.lit(-1))
            less = F.coalesce(F.get(state.counts, leaves), F.lit(0))
            without = F.when(leaves >= 0, state.total - F.get(table, less) + F.get(table, less - 1)).otherwise(state.total)
            now = F.get(state.counts, enters) - (leaves == enters).cast("int")
            total = without - F.get(table, now) + F.get(table, now + 1)
            counts = F.transform(state.counts, lambda c, k: c + (k == enters).cast("int") - (k == leaves).cast("int"))
            bits = F.when(j >= WINDOW - 1, math.log2(WINDOW) - total / WINDOW).otherwise(F.lit(0.0))
            return F.struct(counts.alias("counts"), total.alias("total"), F.greatest(state.best, bits).alias("best"))

        begin = F.struct(F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), begin, step).best

    return let(chars, lambda c: let(terms, lambda t: slide(c, t)))


def _suspicious(candidate: Column) -> Column:
    """The first class that the candidate belongs to decides."""
    threshold = F.lit(None).cast("double")
    for pattern, needs, bits in reversed(CLASSES.values()):
        belongs = reduce(Column.__and__, [candidate.rlike(p) for p in (pattern, *needs)])  # each a single pass
        threshold = F.when(belongs, F.lit(bits)).otherwise(threshold)
    asked = threshold.isNotNull() & ~candidate.rlike(ALLOWED)
    return F.when(asked, window_entropy(candidate) >= threshold).otherwise(F.lit(False))


def _entropy_spans(text: Column, base: Column) -> Column:
    """Candidates of high entropy outside the spans of the patterns."""
    names = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))

    def free(s):
        return ~F.exists(base, lambda b: (b.start < s.end) & (s.start < b.end))

    picked = let(names, lambda m: F.filter(_places(text, CANDIDATE, KINDS.index(ENTROPY)), lambda s, i: free(s) & _suspicious(F.get(m, i))))
    return _if_any(text, CANDIDATE, picked)


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.end)), ",")


def _spans(docs: DataFrame) -> DataFrame:
    """Adds __text, __base and __spans; projects in steps, so that each text is scanned once for each pattern."""
    return (
        docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit("")))
        .withColumn("__base", let(F.struct(*[_matches(F.col("__text"), k).alias(k) for k in PATTERNS]), lambda s: s))
        .withColumn("__spans", let(F.sort_array(F.concat(*[F.col(f"__base.{k}") for k in PATTERNS])), lambda b: F.sort_array(F.concat(b, _entropy_spans(F.col("__text"), b)))))
    )


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256 and spans ("kind:start:end,...")."""
    rows = _spans(docs.select("doc_id", "text"))
    digest = lambda s: F.sha2(_joined(F.filter(s, lambda x: x.kind < len(PATTERNS))), 256)
    numbers = [F.size(F.col(f"__base.{k}")).cast("long").alias(f"n_{k}") for k in PATTERNS]
    entropy = F.size(F.filter("__spans", lambda x: x.kind == len(PATTERNS))).cast("long").alias("n_entropy")
    return rows.select("doc_id", *numbers, entropy, digest(F.col("__spans")).alias("base_sha256"), _joined(F.col("__spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of its texts replaced by the kind in brackets; n_chars, if there, counts the new text."""
    rows = _spans(docs)
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    text = F.col("__text")

    def step(state, s):
        put = F.concat(state.out, F.substring(text, state.at + 1, s.start - state.at), F.get(names, s.kind))
        return F.struct(F.greatest(state.at, s.end).alias("at"), F.when(s.start >= state.at, put).otherwise(state.out).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    masked = let(F.aggregate("__spans", begin, step), lambda s: F.concat(s.out, F.substring(text, s.at + 1, F.length(text))))
    changed = rows.withColumn("text", F.when(F.size("__spans") > 0, masked).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.size("__spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return changed.select(*[F.col(f"`{n}`") for n in docs.columns])
