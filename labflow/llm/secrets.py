"""Secrets in texts: patterns for known forms, and two character Markov models for strings that only look random.

DataFrame functions only: no Python runs on the executors.
"""

import string

from pyspark.sql import functions as F

from labflow.llm import spans
from labflow.llm.common import spread_sample, with_columns

# The known forms, in the order in which spans with the same start are listed.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"  # value of 8 or more
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LENGTH = 8
KINDS = ("assign", "access", "hex", "random")
# A run below the least length cannot match anywhere inside, so the length may stand in the pattern; not so for
# assignments, where a match that is too short hides what it covers.
ASSIGN_HINT = r"(?i)(?:passw(?:or)?d|secret|token|api_?key)[\"']?\x20*[:=]"

ALPHABET = string.ascii_letters + string.digits + "+/_-="
SEPARATORS = "/_-=+"
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}"
LEAST = 20
THRESHOLD = 0.5  # nats a character
SMOOTHING = 0.5
SAMPLE_DOCS = 500
SAMPLE_RANDOM = 3000


def labelled_samples(docs, text="text", key="doc_id", sample_docs=SAMPLE_DOCS, sample_random=SAMPLE_RANDOM):
    """Training strings (``value``, ``is_random``).

    Ordinary: words of the ``sample_docs`` documents whose key has the smallest hashes, as they are and joined to the
    usual forms of identifiers. Random: ``sample_random`` digests in hex, base 64 and upper-case letters and digits.
    Both numbers bound the sample whatever the size of the table.
    """
    spark = docs.sparkSession
    chosen = spread_sample(docs.select(key), key, sample_docs).collect()
    keys = [r[0] for r in chosen if r[0] is not None]
    words = (
        docs.where(F.col(key).isin(keys) if keys else F.lit(False))
        .orderBy(key)
        .limit(sample_docs)
        .select(F.posexplode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"[A-Za-z]{3,}"), F.lit(0))).alias("n", "a"))
        .withColumn("b", F.reverse("a"))
    )
    a, low, digit = F.col("a"), F.lower("a"), (F.col("n") % 100).cast("string")
    forms = F.array(
        a,
        low,
        F.upper(a),
        F.initcap(low),
        F.concat(low, F.lit("_"), low),
        F.concat(low, F.initcap(low)),
        F.concat(low, F.lit("-"), digit),
        F.concat(F.upper(a), F.lit("_"), digit),
        F.concat(low, F.lit("/"), low),
        F.concat(F.initcap(low), digit),
    )
    ordinary = words.select(F.explode(forms).alias("value"), F.lit(False).alias("is_random"))
    digest = F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256)
    base64 = F.base64(F.unhex(digest))
    shouted = F.upper(F.regexp_replace(base64, "[^A-Za-z0-9]", ""))
    random = spark.range(sample_random).select(
        F.explode(F.array(digest, base64, shouted)).alias("value"), F.lit(True).alias("is_random")
    )
    return ordinary.unionByName(random)


def train(samples, smoothing=SMOOTHING):
    """Log-likelihood ratios of character pairs, random against ordinary, as one flat list.

    Entry ``p * (n + 1) + c`` is for character c after p, both counted from 1 in ``ALPHABET`` (0: the start of a
    string, or a character outside). ``samples``: (value, is_random); null and empty values count for nothing. Only the
    table of pair counts comes to the driver: at most two rows for each pair of the alphabet.
    """
    n = len(ALPHABET)
    place = {c: i + 1 for i, c in enumerate(ALPHABET)}
    chars = F.split("value", "")
    pairs = (
        samples.where("length(value) > 0")
        .select("is_random", F.arrays_zip(F.concat(F.array(F.lit("")), chars).alias("p"), chars.alias("c")).alias("pairs"))
        .select("is_random", F.explode("pairs").alias("pair"))
        .where("pair.c IS NOT NULL")
        .groupBy("is_random", F.col("pair.p").alias("p"), F.col("pair.c").alias("c"))
        .count()
        .where(F.col("c").isin(list(ALPHABET)) & F.col("p").isin(["", *ALPHABET]))
    )
    import math

    counts = {True: {}, False: {}}
    for r in pairs.collect():
        counts[r.is_random][place.get(r.p, 0), place[r.c]] = r["count"]
    sums = {k: [sum(t.get((p, c), 0) for c in range(1, n + 1)) for p in range(n + 1)] for k, t in counts.items()}

    def log_probability(k, p, c):
        return math.log((counts[k].get((p, c), 0) + smoothing) / (sums[k][p] + smoothing * n))

    return [
        log_probability(True, p, c) - log_probability(False, p, c) if c else 0.0
        for p in range(n + 1)
        for c in range(n + 1)
    ]


def _ratios(table):
    """The ratios as one literal that the optimizer turns into an array once."""
    return F.split(F.lit(",".join(f"{x:.6g}" for x in table)), ",").cast("array<double>")


def ratio(value, table):
    """Mean log-likelihood ratio of a string's characters (0 for an empty one)."""
    n = len(ALPHABET) + 1
    ratios = _ratios(table)

    def step(state, char):
        at = F.instr(F.lit(ALPHABET), char)
        return F.struct(at.alias("p"), (state.s + F.get(ratios, state.p * n + at)).alias("s"))

    start = F.struct(F.lit(0).alias("p"), F.lit(0.0).alias("s"))
    return F.aggregate(F.split(value, ""), start, step, lambda state: state.s / F.greatest(F.length(value), F.lit(1)))


def stretches(value, table, least=LEAST, threshold=THRESHOLD):
    """Places (array<struct<from, to>>) of the stretches of a string that look random, widened to its separators.

    A stretch begins where the running sum of the ratios leaves 0 and ends at its highest value before the sum is back
    at 0 or has lost what the least secret is worth. It counts if it has ``least`` or more characters and a mean ratio
    of at least ``threshold``.
    """
    n = len(ALPHABET) + 1
    ratios, drop = _ratios(table), F.lit(float(least * threshold))
    pairs = F.arrays_zip(F.split(F.concat(F.lit(" "), value), "").alias("p"), F.split(value, "").alias("c"))
    gains = F.transform(
        F.filter(pairs, lambda x: x.c.isNotNull()),
        lambda x: F.get(ratios, F.instr(F.lit(ALPHABET), x.p) * n + F.instr(F.lit(ALPHABET), x.c)),
    )
    none = F.expr("cast(array() as array<struct<from:int,to:int>>)")

    def with_last(state):
        size = state.to - state["from"]
        good = (size >= least) & (state.top >= size * threshold)
        return F.when(good, F.array_append(state.found, F.struct(state["from"], state.to))).otherwise(state.found)

    def next_state(at, total, top, start, to, found):
        return F.struct(
            at.alias("at"), total.alias("s"), top.alias("top"), start.alias("from"), to.alias("to"), found.alias("found")
        )

    def step(state, gain):
        total, at, zero = state.s + gain, state.at + 1, F.lit(0.0)
        return (
            F.when((total <= 0) | (state.top - total > drop), next_state(at, zero, zero, at, at, with_last(state)))
            .when(total > state.top, next_state(at, total, total, state["from"], at, state.found))
            .otherwise(next_state(at, total, state.top, state["from"], state.to, state.found))
        )

    begin = next_state(F.lit(0), F.lit(0.0), F.lit(0.0), F.lit(0), F.lit(0), none)
    found = F.aggregate(gains, begin, step, with_last)
    flat = F.translate(value, SEPARATORS, SEPARATORS[0] * len(SEPARATORS))

    def widened(x):
        head = F.substring_index(F.substring(flat, F.lit(1), x["from"]), SEPARATORS[0], -1)
        tail = F.substring_index(F.substring(flat, x.to + 1, F.length(flat)), SEPARATORS[0], 1)
        return F.struct((x["from"] - F.length(head)).alias("from"), (x.to + F.length(tail)).alias("to"))

    return F.array_distinct(F.transform(found, widened))


def _of_kind(kind, found):
    rank = KINDS.index(kind)
    return F.transform(
        found,
        lambda x: F.struct(
            x.start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x.end.alias("end"), x.value.alias("value")
        ),
    )


def scan(docs, table, text="text", out="spans", least=LEAST, threshold=THRESHOLD):
    """Add ``out``: array<struct<start, rank, kind, end, value>>, by start and then kind, of all secrets of a text.

    Places are in code points from 0, ends exclusive. Kinds assign, access and hex are the matches of their patterns,
    leftmost and non-overlapping per kind. Kind random: what they leave of a run of characters of ``ALPHABET``, in
    strings of ``least`` or more characters: whole if the mean log-likelihood ratio by ``table`` is at least
    ``threshold``, else its stretches that are. A null text counts as empty and has no spans. Repeated rows each have
    their result. A column of that name in the input gives way. Time grows with the text and the number of its secrets.
    """
    own = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    none = F.expr("cast(array() as array<string>)")
    candidate = CANDIDATE % least
    long_enough = lambda x: F.length(F.regexp_extract(x.value, ASSIGN, 2)) >= ASSIGN_LENGTH
    with_base = with_columns(
        docs,
        {
            "_base": F.concat(
                _of_kind("assign", F.filter(spans.places(own, ASSIGN, own.rlike(ASSIGN_HINT)), long_enough)),
                _of_kind("access", spans.places(own, ACCESS, own.contains("AKIA"))),
                _of_kind("hex", spans.places(own, HEX, own.rlike(HEX))),
            ),
            "_random": spans.matches(own, candidate),
        },
    )
    whole = lambda x: ratio(x, table) >= threshold
    places = lambda x: stretches(x, table, least, threshold)
    # Their places are worked out only where a candidate, or what a base span may leave of it, looks random.
    looks = F.exists("_random", lambda x: whole(x) | (F.size(places(x)) > 0))
    with_runs = with_columns(with_base, {"_random": F.when((F.size("_base") > 0) | looks, F.col("_random")).otherwise(none)})
    with_runs = with_columns(with_runs, {"_runs": spans.placed(own, candidate, F.col("_random"))})

    def random_spans(x):
        def span(at, to):
            value = F.substring(x.value, at + 1, to - at)
            return F.struct((x.start + at).alias("start"), (x.start + to).alias("end"), value.alias("value"))

        all_of_it = F.array(span(F.lit(0), F.length(x.value)))
        return F.when(whole(x.value), all_of_it).otherwise(F.transform(places(x.value), lambda y: span(y["from"], y.to)))

    left = F.filter(spans.cut(F.col("_runs"), F.col("_base")), lambda x: F.length(x.value) >= least)
    with_parts = with_columns(with_runs, {"_runs": F.when(F.size("_runs") > 0, left).otherwise(F.expr("cast(array() as array<struct<start:bigint,end:bigint,value:string>>)"))})
    random = _of_kind("random", F.flatten(F.transform("_runs", random_spans)))
    found = with_columns(with_parts, {out: F.array_sort(F.concat(F.col("_base"), random))})
    return found.drop("_random", "_base", "_runs")


def spans_text(found, kinds=KINDS):
    """Spans of some kinds as ``kind:start:end``, joined by commas."""
    own = F.filter(found, lambda x: x.kind.isin(list(kinds)))
    return F.array_join(F.transform(own, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")


def redact(text, found, mark="[SECRET]"):
    """The text with every stretch that spans cover replaced by one mark; null stays null."""
    return spans.replaced(text, found, mark)
