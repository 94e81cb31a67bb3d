"""Secret scans in DataFrame operations only: known patterns, and windows of high entropy.

Every row is handled within itself: no shuffle, no key, no Python. Matches are marked in the text by a
separator and cut out by it, and their offsets are sums of the lengths of the parts before them.
"""

import math

from pyspark.sql import functions as F

MARK = "\x01"  # a mark that the text itself holds is replaced by another character first; no pattern knows either
KEYWORD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
VALUE = r"[A-Za-z0-9+/_.=-]+"
# kind: (pattern, least characters of the match, or of the value where the pattern has one).
# Runs that are too short would be dropped anyway, and contain no other match, so `{n,}` finds the same.
PATTERNS = {
    "assign": (KEYWORD + VALUE, 12),
    "access": (r"AKIA[A-Z0-9]{14,}", 18),
    "hex": (r"[0-9a-f]{16,}", 16),
}
CANDIDATE = r"[A-Za-z0-9+/=_-]"
# Runs of a narrower class within a candidate are candidates of their own: a secret joined to a name by a sign
# (`KEY=`, `key/`, `auth-`), and hexadecimals joined to other letters. A run that no sign or letter joins is whole already.
JOINED = {
    "alnum": r"(?<=[+/=_-])[A-Za-z0-9]{%d,}|(?<![A-Za-z0-9])[A-Za-z0-9]{%d,}+(?=[+/=_-])",
    "hexdigits": r"(?<=[G-Zg-z])[0-9a-fA-F]{%d,}|(?<![0-9a-fA-F])[0-9a-fA-F]{%d,}+(?=[G-Zg-z])",
}
# Bits per character that a window must reach, by the class of the whole candidate or run.
LEAST_BITS = {"hex": 3.0, "alnum": 3.6, "base64": 3.8}
# Candidates that are no secrets: plain words and names, numbers, rules of one or two signs, UUIDs, documented samples.
ALLOWED = (
    r"^[A-Za-z]?[a-z]*(?:[-_/=+]+[A-Za-z]?[a-z]*)*$",
    r"^[A-Z]+(?:[-_/=+]+[A-Z]+)*$",
    r"^[A-Za-z]+$",
    r"^[0-9+/=_-]+$",
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"EXAMPLE",
)
WINDOW = 20
BLOCK = 256


def with_matches(rows, text, pattern, name):
    """Add ``name``: [(start, end, s)] of the leftmost non-overlapping matches, in code points.

    Offsets are prefix sums in two levels (blocks of 256 parts), so that a text of many matches
    takes little more than linear time.
    """
    parts, lens, blocks, bases = (f"_{name}_{x}" for x in ("parts", "lens", "blocks", "bases"))
    marked = F.regexp_replace(F.col(text), pattern, f"{MARK}$0{MARK}")
    block = f"cast(i div {BLOCK} AS int)"
    before = f"{bases}[{block}] + aggregate(slice({lens}, {block} * {BLOCK} + 1, i % {BLOCK}), 0L, (a, x) -> a + x)"
    return (
        rows.withColumn(parts, F.split(marked, MARK))
        .withColumn(lens, F.expr(f"transform({parts}, x -> char_length(x))"))
        .withColumn(blocks, F.expr(f"transform(sequence(0, cast((size({lens}) - 1) div {BLOCK} AS int)), "
                                   f"b -> aggregate(slice({lens}, b * {BLOCK} + 1, {BLOCK}), 0L, (a, x) -> a + x))"))
        .withColumn(bases, F.expr(f"transform(sequence(0, size({blocks}) - 1), b -> aggregate(slice({blocks}, 1, b), 0L, (a, x) -> a + x))"))
        .withColumn(name, F.expr(
            f"transform(filter(sequence(0, size({lens}) - 1), i -> i % 2 = 1), "
            f"i -> struct({before} AS start, {before} + {lens}[i] AS end, {parts}[i] AS s))"))
        .drop(parts, lens, blocks, bases)
    )


def entropy_windows(candidates, window=WINDOW, least_bits=LEAST_BITS, allowed=ALLOWED):
    """Expression: [(start, end, kind)] where windows of ``window`` characters reach the class's entropy.

    Counts of the characters in the window are kept from step to step: one comes in, one goes out, and
    the sum of c * log2(c), in millionths, changes by those two alone. Overlapping windows merge.
    """
    table = ", ".join(f"{round(c * math.log2(c) * 1e6) if c else 0}L" for c in range(window + 2))
    limit = {k: round(window * (math.log2(window) - bits) * 1e6) for k, bits in least_bits.items()}
    kind = "CASE WHEN c.s RLIKE '^[0-9a-fA-F]+$' THEN 'hex' WHEN c.s RLIKE '^[A-Za-z0-9]+$' THEN 'alnum' ELSE 'base64' END"
    bound = f"element_at(map({', '.join(f'{k!r}, {v}L' for k, v in limit.items())}), {kind})"
    known = " OR ".join(f"c.s RLIKE '{p}'" for p in allowed)
    come, go = "(ascii(ch.come) - 42)", "(ascii(ch.go) - 42)"  # codes 43 to 122; a blank before the start is below 1
    n_come = f"element_at(acc.counts, {come})"
    n_go = f"element_at(acc.counts, {go})"
    change = (
        f"CASE WHEN ch.come = ch.go THEN 0L ELSE acc.t[{n_come} + 1] - acc.t[{n_come}] + "
        f"CASE WHEN {go} < 1 THEN 0L ELSE acc.t[{n_go} - 1] - acc.t[{n_go}] END END"
    )
    step = f"""named_struct('i', acc.i + 1,
        'counts', transform(acc.counts, (x, j) -> x + CAST(j + 1 = {come} AS int) - CAST(j + 1 = {go} AS int)),
        'total', acc.total + {change}, 't', acc.t, 'bound', acc.bound,
        'runs', CASE WHEN acc.i + 1 < {window} OR acc.total + {change} > acc.bound THEN acc.runs
            WHEN size(acc.runs) > 0 AND acc.runs[size(acc.runs) - 1].e >= acc.i + 1 - {window}
            THEN concat(slice(acc.runs, 1, size(acc.runs) - 1), array(named_struct('b', acc.runs[size(acc.runs) - 1].b, 'e', acc.i + 1)))
            ELSE concat(acc.runs, array(named_struct('b', acc.i + 1 - {window}, 'e', acc.i + 1))) END)"""
    start = f"""named_struct('i', 0, 'counts', array_repeat(0, 80), 'total', 0L, 't', array({table}), 'bound', {bound},
        'runs', CAST(array() AS array<struct<b:int, e:int>>))"""
    chars = f"arrays_zip(split(c.s, ''), split(concat(repeat(' ', {window}), c.s), '')) "
    # split drops no character; the second list is longer by the window, so the surplus has no incoming one
    chars = f"transform(filter({chars}, z -> z['0'] IS NOT NULL), z -> named_struct('come', z['0'], 'go', z['1']))"
    return F.expr(f"""flatten(transform(filter({candidates}, c -> NOT ({known})), c -> transform(
        aggregate({chars}, {start}, (acc, ch) -> {step}, acc -> acc.runs),
        r -> named_struct('start', c.start + r.b, 'end', c.start + r.e, 'kind', concat('entropy_', {kind})))))""")


def scan(docs, id_col="doc_id", text_col="text", window=WINDOW, least_bits=LEAST_BITS, allowed=ALLOWED):
    """One row per input row: id, the spans of every base kind and ``entropy``, in code points, end exclusive.

    A run joined to other characters is judged by its own class too, beside the candidate that holds it,
    so spans of different kinds may overlap. A null text counts as empty. Rows are handled alone, so repeated or null ids need nothing; other
    columns are ignored.
    """
    text = F.translate(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), MARK, "\x02")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("_text"))
    for kind, (pattern, least) in PATTERNS.items():
        rows = with_matches(rows, "_text", pattern, f"_{kind}")
        lead = f"^{KEYWORD}" if kind == "assign" else "^"  # where the pattern has a value, its length counts
        long_enough = F.filter(f"_{kind}", lambda m: F.char_length(F.regexp_replace(m["s"], lead, "")) >= least)
        rows = rows.withColumn(kind, F.transform(long_enough, lambda m: F.struct(m["start"], m["end"])))
        rows = rows.drop(f"_{kind}")
    rows = with_matches(rows, "_text", f"{CANDIDATE}{{{window},}}", "_candidates")
    for name, pattern in JOINED.items():
        rows = with_matches(rows, "_text", pattern % (window, window), f"_{name}")
    every = f"concat(_candidates, {', '.join(f'_{name}' for name in JOINED)})"
    found = rows.withColumn("entropy", entropy_windows(every, window, least_bits, allowed))
    return found.drop("_text", "_candidates", *[f"_{name}" for name in JOINED])


def report(found):
    """doc_id, counts per base kind, the digest of the base spans, and all spans as text."""

    def named(column, kind, order):
        return F.transform(F.col(column), lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("o"), s["end"].alias("end"), kind(s).alias("kind")))

    base = [named(k, lambda s, k=k: F.lit(k), n) for n, k in enumerate(PATTERNS)]
    entropy = named("entropy", lambda s: s["kind"], len(PATTERNS))

    def text(spans):
        return F.array_join(F.transform(F.array_sort(F.concat(*spans)), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in PATTERNS],
        F.sha2(text(base), 256).alias("base_sha256"), text([*base, entropy]).alias("spans"),
        F.size("entropy").cast("long").alias("n_entropy"),
    )
