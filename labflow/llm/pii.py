"""Personal data in texts: patterns for known forms, and boosted trees that judge what generous generators propose.

Generators propose overlapping spans: every run of digit groups is cut into windows of neighbouring groups, and mail
addresses are taken in disguised forms too. Format and context of a candidate are whole numbers, which boosted oblivious
trees turn into log-odds; per kind, a threshold calibrated on rows kept aside selects what is added to the matches of the
patterns. DataFrame functions only: no Python runs on the executors; the trees are fitted on the driver from counts of
equal feature vectors of a bounded sample.
"""

import math
from dataclasses import dataclass

from pyspark.sql import functions as F

from labflow.llm import spans
from labflow.llm.common import spread_sample, with_columns
from labflow.llm.spans import let

# The known forms, in the order in which spans are listed. A match can begin only where a run of its
# characters does (or where the match before ended), and is never given back in part, so that long runs are read once.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})"
IP_VALID = rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"
KINDS = ("email", "ip", "card", "phone")
ADDED = tuple(f"{kind}_like" for kind in KINDS)
CARD_DIGITS, PHONE_DIGITS = (16, 19), (8, 15)

# Generators. Digit groups with up to three separators between them, seven digits at least.
NUMBERS = r"[+(]{0,2}[0-9](?:[\x20().+/-]{0,3}+[0-9]){6,}+"
AT = r"(?:\x20?(?:\([aA][tT]\)|\[[aA][tT]\]|\{[aA][tT]\}|@)\x20?|\x20[aA][tT]\x20)"
DOT = r"(?:\x20?(?:\([dD][oO][tT]\)|\[[dD][oO][tT]\]|\{[dD][oO][tT]\})\x20?|\x20[dD][oO][tT]\x20|\.)"
ADDRESS = rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+{AT}[A-Za-z0-9-]{{1,63}}+(?:{DOT}[A-Za-z0-9-]{{1,63}}+){{1,8}}+"
WINDOW = 8  # digit groups
CANDIDATE_DIGITS = (7, 19)
CONTEXT = 24  # characters
KEYWORDS = {
    "email": "e-?mail|contact|kontakt|correo|courriel|write to",
    "ip": r"\bip\b|address|host|server|adresse",
    "card": "card|visa|master|amex|credit|karte|carte|tarjeta",
    "phone": r"phone|\btel|call|fax|mobil|handy|portable|llam",
}
TOP_LEVEL = "com|org|net|edu|gov|info|io|eu|uk|de|fr|es"

FEATURES = (
    "kind digits groups longest shortest separators luhn octets prefix first own_word other_word before after left right even"
).split()
TREES, DEPTH, RATE, SHRINK = 30, 3, 0.3, 2.0
PRECISION = 0.99
SAMPLE_DOCS = 2000
SAMPLE_MADE = 10_000
SPAN = "struct<kind:string,start:bigint,end:bigint>"
CANDIDATE = "struct<kind:int,start:bigint,end:bigint,value:string,f:array<int>>"


@dataclass
class Model:
    """Per kind: log-odds before any tree, trees [([(feature, limit) per level], leaf values)], and the least log-odds
    selected (None: nothing is)."""

    bias: list
    trees: list
    thresholds: list


# ---- known forms ----------------------------------------------------------------------------------------------


def digits_of(value):
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits):
    """Whether a string of digits ends in its check digit."""
    doubled = F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])

    def checked(own):
        # Every second digit from the right counts doubled.
        places = F.transform(F.split(F.reverse(own), ""), lambda c, i: F.when(i % 2 == 1, F.get(doubled, c.cast("int"))).otherwise(c.cast("int")))
        return (own != "") & (F.aggregate(places, F.lit(0), lambda total, x: total + x) % 10 == 0)

    return let(digits, checked)


def valid(kind, value):
    """Whether a match of a kind's pattern is kept."""
    if kind == "ip":
        return value.rlike(IP_VALID)
    if kind == "email":
        return F.lit(True)
    if kind == "phone":
        return F.length(digits_of(value)).between(*PHONE_DIGITS)
    return let(digits_of(value), lambda d: F.when(F.length(d).between(*CARD_DIGITS), luhn(d)).otherwise(False))


def base_spans(text):
    """Valid matches of the known forms: array<struct<kind, start, end>>, by kind and start."""
    hints = {
        "email": (EMAIL, text.contains("@")),
        "ip": (IP, text.rlike(r"[0-9]\.[0-9]+\.[0-9]")),
        "card": (CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}")),
        "phone": (PHONE, text.contains("+")),
    }

    def of(kind, pattern, hint):
        return _of_kind(kind, F.filter(spans.places(text, pattern, hint), lambda x: valid(kind, x.value)))

    return F.concat(*[of(kind, *hints[kind]) for kind in KINDS])


def _of_kind(kind, found):
    return F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x.start.alias("start"), x.end.alias("end")))


# ---- candidates -----------------------------------------------------------------------------------------------


def _side(char):
    """Kind of character beside a candidate: 0 space or nothing, 1 punctuation, 2 letter, digit or other."""
    return F.when(char.rlike(r"^\s?$"), 0).when(char.rlike(r"^\p{Punct}$") & (char != "_"), 1).otherwise(2)


def _words(left, kind):
    """Whether words of a kind, and of another kind, stand before a candidate."""
    own = F.lower(left).rlike(KEYWORDS[kind])
    other = F.lower(left).rlike("|".join(KEYWORDS[k] for k in KINDS if k != kind))
    return own.cast("int"), other.cast("int")


def _candidate(kind, start, end, value, features):
    """``features``: all but the kind, in the order of ``FEATURES``."""
    number = F.lit(KINDS.index(kind))
    whole = F.array(number, *[F.coalesce(x.cast("int"), F.lit(0)) for x in features])
    return F.struct(number.alias("kind"), start.alias("start"), end.alias("end"), value.alias("value"), whole.alias("f"))


def _number_candidates(run):
    """Windows of the digit groups of a run, as a card, a phone number or an IP address wherever the form admits it."""
    none = F.expr(f"cast(array() as array<{CANDIDATE}>)")

    def from_group(groups, seps, ends, i):
        size = F.size(groups)
        head = F.get(seps, i)
        # An opening sign belongs to the number.
        sign = F.regexp_extract(head, r"[+(]+$", 0)
        start = F.get(ends, i) - F.length(F.get(groups, i)) - F.length(sign)
        lasts = F.sequence(i, F.least(i + (WINDOW - 1), size - 1))

        def window(last):
            own = F.slice(groups, i + 1, last - i + 1)
            between = F.slice(seps, i + 2, last - i)
            return F.struct(last.alias("last"), own.alias("own"), between.alias("seps"), F.array_join(own, "").alias("digits"))

        fit = F.filter(
            F.transform(lasts, window), lambda w: F.length(w.digits).between(*CANDIDATE_DIGITS)
        )
        return F.flatten(F.transform(fit, lambda w: judged(groups, seps, ends, i, start, sign, w)))

    def judged(groups, seps, ends, i, start, sign, w):
        lengths = F.transform(w.own, lambda g: F.length(g))
        between = F.array_join(w.seps, "")
        separators = (
            F.when(between == "", 0)
            .when(between.rlike(r"^\x20+$"), 1)
            .when(between.rlike("^-+$"), 2)
            .when(between.rlike(r"^\.+$"), 3)
            .otherwise(4)
        )
        octets = F.forall(w.own, lambda g: (F.length(g) <= 3) & (g.try_cast("int") <= 255))
        prefix = (
            F.when(sign.contains("+"), 1).when(w.digits.startswith("00"), 2).when(sign.contains("("), 4).when(w.digits.startswith("0"), 3).otherwise(0)
        )
        later = F.size(groups) - 1 - w.last
        left = F.when(i == 0, _side(F.substring(run.left, -1, 1))).when(F.get(seps, i).rlike(r"^\x20"), 3).otherwise(4)
        right = F.when(later == 0, _side(F.substring(run.right, 1, 1))).when(F.get(seps, w.last + 1).rlike(r"^\x20"), 3).otherwise(4)
        even = F.size(F.array_distinct(F.slice(lengths, F.lit(1), F.size(lengths) - 1))) <= 1
        end = run.start + F.get(ends, w.last)
        value = F.substring(run.value, (start + 1).cast("int"), (F.get(ends, w.last) - start).cast("int"))

        count = F.length(w.digits)
        form = [count, F.size(w.own), F.least(F.array_max(lengths), F.lit(20)), F.array_min(lengths), separators]
        form += [luhn(w.digits), octets, prefix, F.substring(w.digits, 1, 1)]
        around = [F.least(i, F.lit(3)), F.least(later, F.lit(3)), left, right, even]

        def of(kind):
            return _candidate(kind, run.start + start, end, value, [*form, *_words(run.left, kind), *around])

        own = F.array(
            F.when(count.between(13, 19), of("card")),
            F.when(count <= 15, of("phone")),
            F.when((F.size(w.own) == 4) & (F.array_join(w.seps, "") == "..."), of("ip")),
        )
        return F.filter(own, lambda x: x.isNotNull())

    def made(groups, seps):
        lengths = F.zip_with(
            F.slice(seps, F.lit(1), F.size(groups)), groups, lambda s, g: (F.length(s) + F.length(g)).cast("bigint")
        )
        firsts = F.sequence(F.lit(0), F.size(groups) - 1)
        return let(
            spans.running(lengths),
            lambda ends: F.flatten(F.transform(firsts, lambda i: from_group(groups, seps, ends, i))),
        )

    groups = F.regexp_extract_all(run.value, F.lit("[0-9]+"), F.lit(0))
    seps = F.split(run.value, "[0-9]+", -1)
    return F.coalesce(let(groups, lambda g: let(seps, lambda s: made(g, s))), none)


def _address_candidate(x):
    """A mail address, plain or disguised."""
    at = F.regexp_extract(x.value, AT, 0)
    local = F.split_part(x.value, at, F.lit(1))
    domain = F.substring(x.value, F.length(local) + F.length(at) + 1, F.length(x.value))
    labels = F.split(domain, DOT, -1)
    last = F.lower(F.element_at(labels, -1))
    dots = F.regexp_replace(domain, "[A-Za-z0-9-]+", "")
    form = lambda s, plain: F.when(s.rlike(plain), 0).when(s.rlike(r"[(\[{]"), 1).otherwise(2)
    known = last.rlike(f"^(?:{TOP_LEVEL})$")
    features = [
        form(at, "^@$"),
        F.size(labels),
        F.least(F.length(last), F.lit(20)),
        F.least(F.length(local), F.lit(20)),
        form(dots, r"^\.+$"),
        known,
        local.rlike("[0-9._]"),
        at.contains(" ").cast("int") + domain.contains(" ").cast("int"),
        last.rlike("^[a-z]+$"),
        *_words(x.left, "email"),
        F.lit(0),
        F.lit(0),
        _side(F.substring(x.left, -1, 1)),
        _side(F.substring(x.right, 1, 1)),
        domain.rlike(r"^[a-z0-9-]+(?:\.[a-z0-9-]+)*$"),
    ]
    return _candidate("email", x.start, x.end, x.value, features)


def candidates(text):
    """All proposed spans: array<struct<kind (place in ``KINDS``), start, end, value, f (see ``FEATURES``)>>.

    For a mail address the fields of ``FEATURES`` have meanings of their own: form of the at sign, labels, length of the
    last label and of the local part, form of the dots, known last label, a mark in the local part, spaces, letters only.
    """
    with_left = lambda x: F.struct(
        x.start.alias("start"),
        x.end.alias("end"),
        x.value.alias("value"),
        F.substring(x.left, -CONTEXT, CONTEXT).alias("left"),
        F.substring(x.right, 1, 1).alias("right"),
    )
    runs = F.transform(spans.places(text, NUMBERS, text.rlike(NUMBERS)), with_left)
    addresses = F.transform(spans.places(text, ADDRESS, text.rlike(ADDRESS)), with_left)
    numbers = F.flatten(F.transform(runs, _number_candidates))
    return F.concat(numbers, F.transform(addresses, _address_candidate))


# ---- labelled sample ------------------------------------------------------------------------------------------

# Made examples: kind ('' for none) and form. '#' is a digit, '*' the check digit of the value, '!' a wrong one, '~' a
# number up to 255, '^' a digit from 2 to 9, '@@' and '..' stand for forms of the at sign and the dot.
FORMS = [
    ("card", "^##############*"),
    ("card", "^### #### #### ###*"),
    ("card", "^###-####-####-###*"),
    ("card", "^### ###### ####*"),
    ("card", "^###########*"),
    ("phone", "+## ### #######"),
    ("phone", "+# (###) ###-####"),
    ("phone", "+##-###-######"),
    ("phone", "(0##) #######"),
    ("phone", "(^##) ^##-####"),
    ("phone", "0### #######"),
    ("phone", "0###/######"),
    ("phone", "0##-#######"),
    ("phone", "00## ### ######"),
    ("phone", "^##-^##-####"),
    ("phone", "0# ## ## ## ##"),
    ("ip", "~.~.~.~"),
    ("ip", "1#.~.~.#"),
    ("ip", "1^#.1##.^.~"),
    ("email", "word.##@@host..tld"),
    ("email", "word@@host..tld"),
    ("email", "word_word@@word.host..tld"),
    ("", "^##############!"),
    ("", "^### #### #### ###!"),
    ("", "^############!"),
    ("", "20##-1#-2#"),
    ("", "2#.1#.20## 1#:4#"),
    ("", "##.###.###"),
    ("", "978-#-##-######-!"),
    ("", "~.~.~.~.~"),
    ("", "^##.###.###.###"),
    ("", "#.#.## ##.# #.## ###.#"),
    ("", "## ## ## ## ## ## ## ##"),
    ("", "####### ####### #######"),
    ("", "^#########"),
    ("", "############!"),
    ("", "^################################"),
    ("", "19## - 20##"),
    ("", "5#.###### 1#.######"),
    ("", "20##1#2#####"),
    ("", "word at word.word"),
    ("", "word at home. Word"),
    ("", "word @ word.word"),
]
HOSTS = ["example", "mail3", "uni-x", "posteo", "web7"]
ENDS = TOP_LEVEL.split("|")
ATS = ["@", " (at) ", "[at]", " at ", " @ ", "(at)"]
DOTS = [".", " (dot) ", "[dot]", " dot ", "."]
LEFTS = {
    "card": ["card: ", "visa ", "Kreditkarte ", "tarjeta "],
    "phone": ["call ", "Tel. ", "phone: ", "fax ", "mobile "],
    "ip": ["from host ", "IP ", "server "],
    "email": ["contact ", "e-mail: ", "write to "],
}
PLAIN = ["word ", "the ", "", "; ", "(", "number 12 ", "order 4711 ", "of 7 ", "555-0100 ", "and\n"]
AFTER = [" word", ".", "", ", the", ")", " 20", " 4711 3", "\nword", " and 9807915762804490"]
WORDS = ["anna", "river", "maria", "stone", "look", "meeting", "lake", "info"]


def _picked(items, number):
    return F.element_at(F.array(*[F.lit(x) for x in items]), (F.pmod(number, F.lit(len(items))) + 1).cast("int"))


def made_examples(spark, rows):
    """``rows`` texts with one value each: (text, kind, start, end); the kind is '' where the value is nothing personal."""
    forms = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).alias("form")) for k, v in FORMS])
    picked = spark.range(rows).select(
        "id", F.element_at(forms, (F.col("id") % len(FORMS) + 1).cast("int")).alias("x")
    )
    digest = lambda salt: F.xxhash64(F.col("id"), F.lit(salt))
    numbers = F.translate(F.sha2(F.concat(F.lit("digits "), F.col("id").cast("string")), 256), "abcdef", "271828")
    letters = F.split("x.form", "")

    def filled(char, i):
        digit = F.substring(numbers, i % 60 + 1, F.lit(1))
        some = F.pmod(F.xxhash64(F.col("id"), i), F.lit(256)).cast("string")
        return F.when(char == "#", digit).when(char == "^", (digit.cast("int") % 8 + 2).cast("string")).when(char == "~", some).otherwise(char)

    value = F.array_join(F.transform(letters, filled), "")
    for name, choices in (("word", WORDS), ("host", HOSTS), ("tld", ENDS), ("@@", ATS), ("..", DOTS)):
        value = F.replace(value, F.lit(name), _picked(choices, digest(name)))
    every = F.array(*[F.lit(str(d)) for d in range(10)])
    # The digit that completes the sum of the others.
    check = let(digits_of(value), lambda own: F.element_at(F.filter(every, lambda d: luhn(F.concat(own, d))), 1))
    wrong = ((check.cast("int") + 1 + F.pmod(digest("wrong"), F.lit(9))) % 10).cast("string")
    made = picked.select("id", "x.kind", value.alias("value"), check.alias("check"), wrong.alias("wrong")).withColumn(
        "value", F.translate(F.replace(F.replace("value", F.lit("*"), F.col("check")), F.lit("!"), F.col("wrong")), "*!", "")
    )
    key = F.lit(None).cast("string")
    for kind, words in LEFTS.items():
        key = F.when(F.col("kind") == kind, _picked(words, digest("key"))).otherwise(key)
    anyones = _picked([w for words in LEFTS.values() for w in words], digest("any"))
    turn = F.pmod(digest("turn"), F.lit(10))
    left = F.when(turn < 3, F.coalesce(key, anyones)).when(turn < 4, anyones).otherwise(_picked(PLAIN, digest("plain")))
    start = F.length("left").cast("bigint")
    return made.select("kind", "value", left.alias("left"), _picked(AFTER, digest("after")).alias("after")).select(
        F.concat("left", "value", "after").alias("text"),
        "kind",
        start.alias("start"),
        (start + F.length("value")).alias("end"),
    )


def labelled_candidates(docs, text="text", key="doc_id", sample_docs=SAMPLE_DOCS, sample_made=SAMPLE_MADE):
    """Candidates with ``label`` (1: personal) and ``aside`` (kept for calibration).

    From ``sample_made`` made texts: a candidate is personal if it is the value that was put in, with its kind; one that
    only touches the value is not, and is never kept aside, as it is no false alarm. From the
    ``sample_docs`` documents with the smallest hashes of their keys: candidates that touch no match of the known forms,
    personal if their own text is one. Both numbers bound the sample whatever the size of the table.
    """
    spark = docs.sparkSession
    proposals = candidates(F.col("text"))
    made = made_examples(spark, sample_made).withColumn("c", F.explode(proposals))
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("c.kind") + 1)
    value = F.substring("text", (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int"))
    # An opening sign before the value may belong to the candidate.
    placed = (F.col("end") == F.col("c.end")) & F.col("c.start").between(F.col("start") - 2, F.col("start"))
    same = (F.col("kind") == kind) & placed & (F.regexp_replace("c.value", r"^[+(]+", "") == F.regexp_replace(value, r"^[+(]+", ""))
    touches = (F.col("kind") != "") & (F.col("c.start") < F.col("end")) & (F.col("start") < F.col("c.end"))
    first = made.select("c", same.cast("int").alias("label"), (touches & ~same).alias("misplaced"))

    keys = [r[0] for r in spread_sample(docs.select(key), key, sample_docs).collect() if r[0] is not None]
    chosen = docs.where(F.col(f"`{key}`").isin(keys) if keys else F.lit(False)).orderBy(key).limit(sample_docs)
    own = chosen.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    proposed = own.select(proposals.alias("all"), base_spans(F.col("text")).alias("base"))
    alone = proposed.select(F.explode(spans.outside(F.col("all"), F.col("base"))).alias("c"))
    value = F.col("c.value")
    whole = {"email": f"^{EMAIL}$", "ip": f"^{IP}$", "card": f"^{CARD}$", "phone": f"^{PHONE}$"}
    known = F.lit(False)
    for i, k in enumerate(KINDS):
        known = F.when(F.col("c.kind") == i, value.rlike(whole[k]) & valid(k, value)).otherwise(known)
    second = alone.select("c", known.cast("int").alias("label"), F.lit(False).alias("misplaced"))
    aside = (F.pmod(F.xxhash64("c.value", "c.start"), F.lit(4)) == 0) & ~F.col("misplaced")
    return first.unionByName(second).select("c", "label", aside.alias("aside"))


# ---- boosting -------------------------------------------------------------------------------------------------


def train(labelled, trees=TREES, depth=DEPTH, rate=RATE, precision=PRECISION):
    """Boosted oblivious trees on feature vectors, for each kind, and thresholds calibrated on the rows kept aside.

    ``labelled``: (c, label, aside) as in ``labelled_candidates``. Rows are counted by feature vector first; these counts,
    at most as many as the sample has candidates, come to the driver. The threshold of a kind is the lowest score whose
    rows aside, with all above it, are personal in ``precision`` of the cases, counting one miss more than was seen. A
    kind without rows that reach it selects nothing.
    """
    import numpy as np

    counted = labelled.groupBy("c.f", "aside").agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("all")).collect()
    model = Model([], [], [])
    for kind in range(len(KINDS)):
        rows = sorted((r for r in counted if r.f[0] == kind), key=lambda r: (r.f, r.aside))
        x = np.array([r.f for r in rows]).reshape(len(rows), len(FEATURES))
        pos, n = np.array([r.pos for r in rows], "f8"), np.array([r["all"] for r in rows], "f8")
        aside = np.array([r.aside for r in rows], bool)
        bias, grown, score = _boosted(x, pos * ~aside, n * ~aside, trees, depth, rate)
        model.bias.append(bias)
        model.trees.append(grown)
        model.thresholds.append(_threshold(score[aside], pos[aside], n[aside], precision))
    return model


def _boosted(x, pos, n, trees, depth, rate):
    """(bias, trees, log-odds of the rows) by Newton steps; every level of a tree asks one question of all its leaves."""
    import numpy as np

    share = (pos.sum() + 1) / (n.sum() + 2)
    bias = math.log(share / (1 - share))
    score, grown = np.full(len(x), bias), []
    limits = [(j, t) for j in range(x.shape[1]) for t in np.unique(x[:, j])[:-1].tolist()]
    above = [x[:, j] > t for j, t in limits]
    for _ in range(trees if limits else 0):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = pos - n * p, n * p * (1 - p)
        leaf, chosen = np.zeros(len(x), int), []
        for level in range(depth):
            size, best, at = 1 << level, -1.0, 0
            all_g, all_w = np.bincount(leaf, gradient, size), np.bincount(leaf, weight, size)
            for k, side in enumerate(above):
                g, w = np.bincount(leaf[side], gradient[side], size), np.bincount(leaf[side], weight[side], size)
                gain = (g**2 / (w + SHRINK) + (all_g - g) ** 2 / (all_w - w + SHRINK)).sum()
                if gain > best + 1e-12:
                    best, at = gain, k
            chosen.append(limits[at])
            leaf = leaf + (above[at].astype(int) << level)
        size = 1 << depth
        values = rate * np.bincount(leaf, gradient, size) / (np.bincount(leaf, weight, size) + SHRINK)
        values = [float(f"{v:.6g}") for v in values]
        score = score + np.array(values)[leaf]
        grown.append((chosen, values))
    return bias, grown, score


def _threshold(score, pos, n, precision):
    found, seen, right = None, 0.0, 0.0
    rounded = score.round(6)
    for s in sorted(set(rounded.tolist()), reverse=True):
        seen, right = seen + n[rounded == s].sum(), right + pos[rounded == s].sum()
        if right / (seen + 1) >= precision:
            found = s - 1e-6
    return found


def score(x, model):
    """Log-odds of a candidate by the trees of its kind."""

    def of_kind(kind):
        total = F.lit(model.bias[kind])
        for levels, values in model.trees[kind]:
            at = F.lit(0)
            for i, (feature, limit) in enumerate(levels):
                at = at + F.when(F.get(x.f, F.lit(feature)) > limit, 1 << i).otherwise(0)
            total = total + F.get(F.array(*[F.lit(v) for v in values]), at)
        return total

    chosen = F.when(x.kind == 0, of_kind(0))
    for kind in range(1, len(KINDS)):
        chosen = chosen.when(x.kind == kind, of_kind(kind))
    return chosen


# ---- scan -----------------------------------------------------------------------------------------------------


def scan(docs, model, text="text", out="spans"):
    """Add ``out``: array<struct<kind, start, end>>, by kind and start, of all personal data of a text.

    Places are in code points from 0, ends exclusive. Kinds email, ip, card and phone are the valid matches of their
    patterns, leftmost and non-overlapping per kind; the kinds of ``ADDED``, listed after them, are candidates that touch
    none of these and score at least their kind's threshold; of candidates of a kind inside one another the longest
    counts. A null text counts as empty and has no spans. A column of that name in the input gives way.
    """
    own = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    with_all = with_columns(docs, {"_base": base_spans(own), "_all": candidates(own)})
    least = F.array(*[F.lit(t).cast("double") for t in model.thresholds])
    some = F.size("_all") > 0
    # Only candidates that touch no known form are judged.
    alone = F.when(some, spans.outside(F.col("_all"), F.col("_base"))).otherwise(F.col("_all"))
    with_alone = with_columns(with_all, {"_all": alone})
    good = F.filter("_all", lambda x: F.coalesce(score(x, model) >= F.get(least, x.kind), F.lit(False)))
    with_good = with_columns(with_alone, {"_all": F.when(some, good).otherwise(F.col("_all"))})

    def selected(i):
        return _of_kind(ADDED[i], _longest(F.filter("_all", lambda x: x.kind == i)))

    added = [selected(i) for i in range(len(KINDS))]
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    found = F.concat("_base", F.when(some, F.concat(*added)).otherwise(none))
    return with_columns(with_good, {out: found}).drop("_base", "_all")


def _longest(found):
    """Spans that no other one holds, by start."""

    def kept(ordered):
        ends = spans.running(F.transform(ordered, lambda x: -x.minus_end), F.greatest)
        before = F.concat(F.array(F.lit(-1).cast("bigint")), ends)
        zipped = F.zip_with(ordered, F.slice(before, F.lit(1), F.size(ordered)), lambda x, b: F.struct(x.start, (-x.minus_end).alias("end"), b.alias("b")))
        return F.filter(zipped, lambda x: x.end > x.b)

    # The longer of two that start together comes first.
    return let(F.array_sort(F.transform(found, lambda x: F.struct(x.start.alias("start"), (-x.end).alias("minus_end")))), kept)


def spans_text(found, kinds=KINDS + ADDED):
    """Spans of some kinds as ``kind:start:end``, joined by commas."""
    own = F.filter(found, lambda x: x.kind.isin(list(kinds)))
    return F.array_join(F.transform(own, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")


def redact(text, found, mark="[PRIVATE]"):
    """The text with every stretch that spans cover replaced by one mark; null stays null."""
    return spans.replaced(text, found, mark)
