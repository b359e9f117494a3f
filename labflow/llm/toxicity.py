"""Toxicity of whole texts: a bidirectional gated recurrent network with attention pooling over words and characters.

The network reads windows of words. Its input for a word joins a word part (a log-odds value and a trained vector of
the hashed word) and a character part (the largest and the mean log-odds and the mean of trained vectors of the hashed
character runs of the word). All windows of a text overlap and all are scored; the text's score is the highest. The
network is trained in numpy on a bounded sample of labelled rows until it meets a goal on some that are kept aside, and
scored in tasks, many windows at a time.
"""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from labflow.llm.common import ship_package, slices, spread_sample, with_columns

WINDOW, STRIDE = 48, 36
WORD = re.compile(r"\w{1,32}")
WORD_ROWS, RUN_ROWS = 1 << 14, 1 << 16
RUNS = (3, 4, 5)
WORD_SIZE, RUN_SIZE, HIDDEN = 4, 4, 8
SLICE_CHARS = 2 << 20
SAMPLE = 5000
SAMPLE_CHARS = 16_000
# Longer texts are taken whole as well, as long as they sum to no more characters than this.
LONG_CHARS = 4_000_000
BATCH = 128
# Steps of the first start whatever the size of the sample: a small one is gone through more often.
UPDATES = 250
# Steps between the network's choices of windows, at least: a pass over a small sample has fewer.
CHOICE_STEPS = 20
# Starts, each from other random numbers and half of UPDATES longer than the one before, until the goal is met.
TRIES = 3
# Least recall and largest share of clean texts taken for toxic, at the threshold and on rows kept aside. A figure counts
# as missed if a network just at the goal would be as bad with a probability of less than CHANCE.
THRESHOLD = 0.3
GOAL_RECALL, GOAL_CLEAN = 0.85, 0.03
CHANCE = 0.05
# One row in so many of either label is kept aside. With fewer toxic ones than LEAST_ASIDE nothing can be said about the
# goal: the best start is taken.
ASIDE = 5
LEAST_ASIDE = 20
# Scores that are too low lose a toxic text, so its windows weigh a little more.
POSITIVE_WEIGHT = 1.5
SEED = 11
_P = np.uint64(0x100000001B3)


# ---- inputs ---------------------------------------------------------------------------------------------------


def words_of(text):
    """Words in lower case; a longer run of letters and digits counts as several."""
    return WORD.findall(text.lower())


def _scramble(x):
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Runs:
    """Rows of the hashed words and of their hashed character runs, for a list of distinct words."""

    def __init__(self, words):
        flat = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), "u4").astype("u8")
        sizes = np.array([len(w) + 2 for w in words], "i8")
        self.starts = np.cumsum(sizes) - sizes
        ends = np.repeat((self.starts + sizes).astype("i4"), sizes)
        place = np.arange(len(flat), dtype="i4")
        with np.errstate(over="ignore"):
            power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(34, _P)])
            whole = flat * power[place - np.repeat(self.starts.astype("i4"), sizes)]
            self.word = (_scramble(np.add.reduceat(whole, self.starts)) % np.uint64(WORD_ROWS)).astype("i4")
            del whole
            self.runs = []
            total = flat.copy()
            for n in range(2, max(RUNS) + 1):
                total = total * _P
                total[: max(len(flat) - n + 1, 0)] += flat[n - 1 :]
                if n in RUNS:
                    row = (_scramble(total + np.uint64(n)) % np.uint64(RUN_ROWS)).astype("i4")
                    self.runs.append((row, place + n <= ends))
        self.count = np.maximum(sum(np.add.reduceat(ok.astype("f4"), self.starts) for _, ok in self.runs), 1)

    def sums(self, table):
        """Sums of the table's rows over each word's runs."""
        total = 0
        for row, ok in self.runs:
            values = table[row]
            values[~ok] = 0
            total = total + np.add.reduceat(values, self.starts, axis=0)
        return total

    def largest(self, table):
        best = np.full(len(self.starts), -np.inf, "f4")
        for row, ok in self.runs:
            best = np.maximum(best, np.maximum.reduceat(np.where(ok, table[row], -np.inf), self.starts))
        return best


def inputs(runs, odds, vectors):
    """One input row for each word."""
    word_odds, run_odds = odds
    word_vectors, run_vectors = vectors
    count = runs.count[:, None]
    return np.concatenate(
        [
            word_odds[runs.word][:, None],
            runs.largest(run_odds)[:, None],
            runs.sums(run_odds)[:, None] / count,
            word_vectors[runs.word],
            runs.sums(run_vectors) / count,
        ],
        axis=1,
    ).astype("f4")


INPUTS = 3 + WORD_SIZE + RUN_SIZE


def windows(n):
    """Starts of the windows of n words; the last ends with the text."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def indexed(texts):
    """Distinct words of some texts, and their windows: word numbers (-1 where there is none) and text of each."""
    index, rows, owner = {}, [], []
    for i, text in enumerate(texts):
        own = [index.setdefault(w, len(index)) for w in words_of(text)]
        for start in windows(len(own)):
            part = own[start : start + WINDOW]
            rows.append(part if len(part) == WINDOW else part + [-1] * (WINDOW - len(part)))
            owner.append(i)
    return list(index), np.array(rows, "i4").reshape(-1, WINDOW), np.array(owner, "i8")


# ---- network --------------------------------------------------------------------------------------------------


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def new_network(rng):
    def normal(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype("f4")

    network = {}
    for side in ("forward", "backward"):
        network |= {f"{side}_x": normal(INPUTS, 3 * HIDDEN), f"{side}_h": normal(HIDDEN, 3 * HIDDEN)}
        network[f"{side}_b"] = np.zeros(3 * HIDDEN, "f4")
    network |= {"attend": normal(2 * HIDDEN, HIDDEN), "attend_b": np.zeros(HIDDEN, "f4"), "ask": normal(HIDDEN)}
    network |= {"out": normal(2 * HIDDEN), "out_b": np.zeros(1, "f4")}
    return network


def _steps(side):
    return range(WINDOW) if side == "forward" else range(WINDOW - 1, -1, -1)


def forward(network, projected, rows, keep=False):
    """Logits of windows. ``projected``: by side, each word's input times the input weights, the last row for no word.

    With ``keep`` also everything the way back needs.
    """
    n = len(rows)
    there = rows >= 0
    states = np.empty((WINDOW, n, 2 * HIDDEN), "f4")
    trace = {}
    for side, at in (("forward", 0), ("backward", HIDDEN)):
        u, h, trace[side] = network[f"{side}_h"], np.zeros((n, HIDDEN), "f4"), {}
        for t in _steps(side):
            x = projected[side][rows[:, t]]
            hu = h @ u
            gates = _sigmoid(x[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            new = np.tanh(x[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            after = new + z * (h - new)
            if not there[:, t].all():
                after = np.where(there[:, t, None], after, h)
            if keep:
                trace[side][t] = h, hu, z, r, new
            h = after
            states[t, :, at : at + HIDDEN] = h
    asked = np.tanh(states @ network["attend"] + network["attend_b"])
    weights = asked @ network["ask"]
    weights[~there.T] = -1e9
    weights = np.exp(weights - weights.max(0)) * there.T
    weights /= np.maximum(weights.sum(0), 1e-9)
    pooled = np.einsum("tn,tnh->nh", weights, states)
    logits = pooled @ network["out"] + network["out_b"][0]
    return (logits, (there, states, trace, asked, weights, pooled)) if keep else logits


def backward(network, rows, kept, d_logits):
    """Gradients of the network's weights, and by side those of the projected inputs at every step."""
    there, states, trace, asked, weights, pooled = kept
    grads = {k: np.zeros_like(v) for k, v in network.items()}
    grads["out"] = pooled.T @ d_logits
    grads["out_b"][0] = d_logits.sum()
    d_pooled = d_logits[:, None] * network["out"]
    d_weights = np.einsum("nh,tnh->tn", d_pooled, states)
    d_scores = weights * (d_weights - (weights * d_weights).sum(0))
    grads["ask"] = np.einsum("tn,tnh->h", d_scores, asked)
    d_asked = d_scores[:, :, None] * network["ask"] * (1 - asked**2)
    grads["attend"] = np.einsum("tnh,tnk->hk", states, d_asked)
    grads["attend_b"] = d_asked.sum((0, 1))
    d_states = weights[:, :, None] * d_pooled + d_asked @ network["attend"].T
    d_inputs = {}
    for side, at in (("forward", 0), ("backward", HIDDEN)):
        u, carried = network[f"{side}_h"], np.zeros((len(rows), HIDDEN), "f4")
        d_inputs[side] = np.zeros((WINDOW, len(rows), 3 * HIDDEN), "f4")
        for t in reversed(_steps(side)):
            h, hu, z, r, new = trace[side][t]
            total = carried + d_states[t, :, at : at + HIDDEN]
            m = there[:, t, None]
            d_after = total * m
            d_new = d_after * (1 - z) * (1 - new**2)
            d_x = np.concatenate([d_after * (h - new) * z * (1 - z), d_new * hu[:, 2 * HIDDEN :] * r * (1 - r), d_new], axis=1)
            d_hu = d_x.copy()
            d_hu[:, 2 * HIDDEN :] *= r
            carried = total * ~m + d_after * z + d_hu @ u.T
            grads[f"{side}_h"] += h.T @ d_hu
            d_inputs[side][t] = d_x
    return grads, d_inputs


def project(network, x):
    """Each word's input times the input weights of each side, and a last row for no word."""
    padded = np.concatenate([x, np.zeros((1, x.shape[1]), "f4")])
    return {side: padded @ network[f"{side}_x"] + network[f"{side}_b"] for side in ("forward", "backward")}


# ---- training -------------------------------------------------------------------------------------------------


def _sum_by(rows, values, n):
    """Sums of the values' rows by number, as a table of n rows."""
    return np.stack([np.bincount(rows, c, n) for c in values.T], axis=1).astype("f4")


def _counts(texts, labels):
    """By label, the texts that hold each hashed word and each hashed character run."""
    counts = [np.zeros((2, WORD_ROWS)), np.zeros((2, RUN_ROWS))]
    for text, label in zip(texts, labels):
        own = list(dict.fromkeys(words_of(text)))
        if own:
            runs = Runs(own)
            there = np.zeros(WORD_ROWS, bool), np.zeros(RUN_ROWS, bool)
            there[0][runs.word] = True
            for row, ok in runs.runs:
                there[1][row[ok]] = True
            counts[0][label] += there[0]
            counts[1][label] += there[1]
    return counts


def _log_odds(counts, labels, strength=2.0):
    """Smoothed log-odds of each hashed word and character run, by the texts that hold it."""
    share = sum(labels) / len(labels)
    return [
        (np.log((c[1] + strength * share) / (c.sum(0) + strength)) - np.log(share)).clip(-4, 4).astype("f4") for c in counts
    ]


def _kept_aside(labels, rng):
    """Places of the rows kept aside: one in ``ASIDE`` of either label."""
    own = [rng.permutation(np.flatnonzero(np.array(labels) == y)) for y in (0, 1)]
    return set(np.concatenate([x[: len(x) // ASIDE] for x in own]).tolist())


def _as_bad(missed, n, rate):
    """The probability of ``missed`` or more of n where each is missed with the probability ``rate``."""
    return 1 - sum(math.comb(n, k) * rate**k * (1 - rate) ** (n - k) for k in range(missed))


def measure(model, texts, labels, threshold=THRESHOLD):
    """Recall and share of clean texts at or above the threshold, and whether the goal is met."""
    truth = np.array(labels)
    hit = score_texts(model, texts) >= threshold
    toxic, clean = int((truth == 1).sum()), int((truth == 0).sum())
    missed, wrong = int((~hit & (truth == 1)).sum()), int((hit & (truth == 0)).sum())
    return {
        "recall": 1 - missed / max(toxic, 1),
        "clean": wrong / max(clean, 1),
        "toxic_rows": toxic,
        "met": _as_bad(missed, toxic, 1 - GOAL_RECALL) >= CHANCE and _as_bad(wrong, clean, GOAL_CLEAN) >= CHANCE,
    }


def train(texts, labels, updates=UPDATES, seed=SEED, tries=TRIES, threshold=THRESHOLD):
    """A model from texts and labels (0 or 1), with what it reached on rows kept aside as ``measured``.

    Texts of one label only, or without words, give a model that returns the share of label 1.

    Starts follow each other until one meets the goal; if none does the best is taken where too few toxic texts are kept
    aside to tell, and else an error is raised. Where a label has too few rows to keep any aside, there is one start.
    """
    labels = [int(x) for x in labels]
    share = sum(labels) / max(len(labels), 1)
    if not 0 < share < 1 or not any(map(WORD.search, texts)):
        return {"share": share}
    aside = _kept_aside(labels, np.random.default_rng(seed))
    learnt = [(t, y) for i, (t, y) in enumerate(zip(texts, labels)) if i not in aside]
    kept = [(t, y) for i, (t, y) in enumerate(zip(texts, labels)) if i in aside]
    if not 0 < sum(y for _, y in kept) < len(kept) or not any(WORD.search(t) for t, _ in learnt):
        return _start(texts, labels, updates, seed)
    best = None
    for k in range(tries):
        model = _start(*zip(*learnt), updates + k * updates // 2, seed + k)
        model["measured"] = found = measure(model, *zip(*kept), threshold)
        if best is None or (found["met"], found["recall"] - found["clean"]) > best[0]:
            best = (found["met"], found["recall"] - found["clean"]), model
        if found["met"]:
            break
    met, found = best[0][0], best[1]["measured"]
    if not met and found["toxic_rows"] >= LEAST_ASIDE:
        raise ValueError(f"no start of {tries} met the goal (recall {GOAL_RECALL}, clean {GOAL_CLEAN}): {found}")
    return best[1]


def _start(texts, labels, updates, seed):
    """A model from one start.

    A label says that some window of the text is toxic, not which. Each epoch takes the highest-scored window of every
    text (by log-odds for the first quarter of the steps), and as many windows of clean texts at random. Log-odds that
    the network trains on come from the other half of the texts, so that it meets them as it will on new texts.
    """
    rng = np.random.default_rng(seed)
    half = rng.permutation(len(texts)) % 2
    sides = [[(t, y) for t, y, k in zip(texts, labels, half) if k == side] for side in (0, 1)]
    counts = [_counts([t for t, _ in side], [y for _, y in side]) for side in sides]
    all_odds = _log_odds([a + b for a, b in zip(*counts)], labels)
    side_labels = [[y for _, y in side] for side in sides]
    if all(0 < sum(y) < len(y) for y in side_labels):
        crossed = [_log_odds(counts[1 - side], side_labels[1 - side]) for side in (0, 1)]
    else:
        crossed = [all_odds] * 2
    vectors = [
        (rng.standard_normal((WORD_ROWS, WORD_SIZE)) * 0.1).astype("f4"),
        (rng.standard_normal((RUN_ROWS, RUN_SIZE)) * 0.1).astype("f4"),
    ]
    words, rows, owner = indexed(texts)
    runs = Runs(words)
    truth = np.array(labels)[owner]
    side_of = half[owner]
    network = new_network(rng)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.items()}
    step, chosen_at = 0, -CHOICE_STEPS
    scores = np.empty(len(rows), "f4")
    x = [inputs(runs, odds, vectors) for odds in crossed]
    for k in (0, 1):
        strongest = np.r_[x[k][:, 1] + x[k][:, 0], np.float32(-9)]
        own = side_of == k
        scores[own] = strongest[rows[own]].max(1)
    while step < updates:
        # The network's own choice of windows counts once it has learnt something.
        if step >= updates // 4 and step - chosen_at >= CHOICE_STEPS:
            chosen_at = step
            for k in (0, 1):
                own = np.flatnonzero(side_of == k)
                projected = project(network, inputs(runs, crossed[k], vectors))
                for start in range(0, len(own), 8192):
                    part = own[start : start + 8192]
                    scores[part] = forward(network, projected, rows[part])
        order = np.lexsort((-scores, owner))
        first = order[np.r_[True, owner[order][1:] != owner[order][:-1]]]
        other = np.flatnonzero(truth == 0)
        chosen = np.concatenate([first, rng.choice(other, min(len(other), len(first)), replace=False)])
        # Some of the others are cut to a few words or none, so that little or no text is not taken for toxic.
        cut = np.r_[np.full(len(first), WINDOW), np.where(rng.random(len(chosen) - len(first)) < 0.3, rng.integers(0, 9, len(chosen) - len(first)), WINDOW)]
        turn = rng.permutation(len(chosen))
        chosen, cut = chosen[turn], cut[turn]
        for start in range(0, len(chosen), BATCH):
            part = chosen[start : start + BATCH]
            shown = np.where(np.arange(WINDOW) < cut[start : start + BATCH, None], rows[part], -1)
            used, place = np.unique(shown, return_inverse=True)
            # The number of no word, if there is one, comes first.
            local = np.where(shown >= 0, place.reshape(shown.shape) - (used[0] < 0), -1)
            used = used[used >= 0]
            step += 1
            if not len(used):
                continue
            batch = Runs([words[i] for i in used])
            both = [inputs(batch, odds, vectors) for odds in crossed]
            # Windows of each half read the log-odds of the other one.
            stacked = np.concatenate(both)
            shifted = np.where(local >= 0, local + side_of[part][:, None] * len(used), -1)
            logits, kept = forward(network, project(network, stacked), shifted, keep=True)
            weight = np.where(truth[part] == 1, POSITIVE_WEIGHT, 1.0) / len(part)
            d_logits = ((_sigmoid(logits) - truth[part]) * weight).astype("f4")
            grads, d_inputs = backward(network, shifted, kept, d_logits)
            d_stacked = np.zeros_like(stacked)
            for side in ("forward", "backward"):
                d = d_inputs[side]
                flat, steps = shifted.T.reshape(-1), d.reshape(-1, d.shape[2])
                real = flat >= 0
                grads[f"{side}_b"] = steps[real].sum(0)
                gathered = _sum_by(flat[real], steps[real], len(stacked))
                grads[f"{side}_x"] = stacked.T @ gathered
                d_stacked += gathered @ network[f"{side}_x"].T
            for name, g in grads.items():
                m, v = moments[name]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                network[name] -= (rate * m / (np.sqrt(v) + 1e-8)).astype("f4")
            d_words = d_stacked[: len(used)] + d_stacked[len(used) :]
            vectors[0] -= _sum_by(batch.word, 0.5 * d_words[:, 3 : 3 + WORD_SIZE], WORD_ROWS)
            d_runs = 0.5 * d_words[:, 3 + WORD_SIZE :] / batch.count[:, None]
            spread = np.repeat(d_runs, np.diff(np.r_[batch.starts, len(batch.runs[0][0])]), axis=0)
            for row, ok in batch.runs:
                vectors[1] -= _sum_by(row[ok], spread[ok], RUN_ROWS)
    return {"share": sum(labels) / len(labels), "network": network, "odds": all_odds, "vectors": vectors}


def score_texts(model, texts):
    """The highest probability over all windows of each text; a text without words scores 0."""
    if "network" not in model:
        return np.full(len(texts), float(model["share"]))
    words, rows, owner = indexed(texts)
    x = inputs(Runs(words), model["odds"], model["vectors"]) if words else np.zeros((0, INPUTS), "f4")
    projected = project(model["network"], x)
    best = np.full(len(texts), -np.inf)
    for start in range(0, len(rows), 4096):
        part = slice(start, start + 4096)
        np.maximum.at(best, owner[part], forward(model["network"], projected, rows[part]).astype("f8"))
    blank = np.ones(len(texts), bool)
    blank[owner[(rows >= 0).any(1)]] = False
    return np.where(blank, 0.0, 1 / (1 + np.exp(-best)))


# ---- tables ---------------------------------------------------------------------------------------------------


def held_out(key):
    """Whether a row's label is kept from training: crc32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs, labels, rows=SAMPLE, chars=SAMPLE_CHARS, key="doc_id", long_chars=LONG_CHARS):
    """(texts, labels) to train on: at most ``rows`` labelled rows that are not held out, by the hash of their key.

    All parameters bound what comes to the driver: texts of more than ``chars`` characters are taken whole in that order
    as long as they sum to at most ``long_chars``.
    """
    spark = docs.sparkSession
    known = labels.where(F.col("toxic").isin(0, 1) & F.col(key).isNotNull() & ~held_out(F.col(key)))
    known = known.select(F.col(key).alias("_key"), F.col("toxic").cast("int").alias("_toxic"))
    chosen = spread_sample(known, "_key", rows).collect()
    if not chosen:
        return [], []

    def found(keys, lengths):
        # At most ``rows`` rows of two numbers.
        small = F.broadcast(spark.createDataFrame([tuple(r) for r in keys], "_key bigint, _toxic int"))
        texts = docs.select(F.col(key).alias("_id"), "text").where(lengths)
        return texts.join(small, F.col("_id") == F.col("_key"))

    length = F.length("text")
    short = found(chosen, length.between(1, chars)).select("_key", "_toxic", "text").orderBy("_key", "text").limit(rows)
    long = found(chosen, length.between(chars + 1, long_chars)).groupBy("_key").agg(F.sum(length).alias("n"))
    place = {r._key: i for i, r in enumerate(chosen)}
    taken, room = set(), long_chars
    for r in sorted(long.collect(), key=lambda r: place[r._key]):
        if r.n <= room:
            taken.add(r._key)
            room -= r.n
    sample = [(r._key, r.text, r._toxic) for r in short.collect()]
    if taken:
        whole = found([r for r in chosen if r._key in taken], length.between(chars + 1, long_chars))
        sample += [(r._key, r.text, r._toxic) for r in whole.select("_key", "_toxic", "text").collect()]
    sample.sort()
    return [x[1] for x in sample], [x[2] for x in sample]


def score(docs, model, text="text", out="score"):
    """Add ``out``: the score of each whole text, from 0 to 1 (null counts as empty). A column of that name gives way."""
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(batch: pa.Array) -> pa.Array:
        texts = [x or "" for x in batch.to_pylist()]
        found = [np.empty(0)]
        for start, end in slices([len(t) for t in texts], SLICE_CHARS):
            found.append(score_texts(sent.value, texts[start:end]))
        return pa.array(np.concatenate(found), pa.float64())

    return with_columns(docs, {out: scores(F.col(f"`{text}`"))})
