"""Places of matches in texts, by DataFrame functions, in time proportional to the text and the matches.

A span is a struct with ``start`` and ``end`` in code points, the end exclusive. Appending to an array copies it, so
running values are made chunk by chunk; nothing here compares all spans of a text with each other.
"""

from pyspark.sql import functions as F

CHUNK = 256
TEXT_CHUNK = 1024
LAST = (1 << 62) - 1


def let(value, use):
    """``use(value)``, the value being worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def no_longs():
    return F.expr("cast(array() as array<bigint>)")


def running(values, merge=lambda a, b: a + b, start=0):
    """Running sums (or other associative merges) of an array of longs, each with its own element."""
    begin = F.lit(start).cast("bigint")

    def folded(items, read):
        state = F.struct(begin.alias("now"), no_longs().alias("all"))

        def step(s, x):
            merged = merge(s.now, read(x))
            return F.struct(merged.alias("now"), F.array_append(s["all"], merged).alias("all"))

        return F.aggregate(items, state, step)

    def whole(own):
        starts = F.sequence(F.lit(1), F.size(own), F.lit(CHUNK))
        chunks = F.transform(starts, lambda at: folded(F.slice(own, at, F.lit(CHUNK)), lambda x: x))
        return let(chunks, carried)

    def carried(chunks):
        ends = folded(chunks, lambda x: x.now)["all"]
        before = F.concat(F.array(begin), F.slice(ends, F.lit(1), F.size(ends) - 1))
        return F.flatten(F.zip_with(chunks, before, lambda c, b: F.transform(c["all"], lambda x: merge(b, x))))

    return let(values, lambda own: F.when(F.size(own) > 0, whole(own)).otherwise(no_longs()))


MATCH = "struct<start:bigint,end:bigint,value:string,left:string,right:string>"


def matches(text, pattern, hint=None):
    """Matches of a pattern as strings, leftmost and non-overlapping; ``hint`` says cheaply that there may be one."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return found if hint is None else F.when(hint, found).otherwise(F.expr("cast(array() as array<string>)"))


def placed(text, pattern, found):
    """Matches (all that ``matches`` gives, or none) with their places: array<struct<start, end, value, left, right>>.

    ``left`` and ``right`` are the text up to the neighbouring matches. The pattern must not match an empty string.
    """

    def whole(own, between):
        size = F.size(own)
        pairs = F.arrays_zip(F.slice(between, F.lit(1), size).alias("left"), own.alias("value"))
        ends = running(F.transform(pairs, lambda x: (F.length(x.left) + F.length(x.value)).cast("bigint")))
        zipped = F.arrays_zip(
            pairs.alias("pair"), ends.alias("end"), F.slice(between, F.lit(2), size).alias("right")
        )
        return F.transform(
            zipped,
            lambda x: F.struct(
                (x.end - F.length(x.pair.value)).alias("start"),
                x.end.alias("end"),
                x.pair.value.alias("value"),
                x.pair.left.alias("left"),
                x.right.alias("right"),
            ),
        )

    none = F.expr(f"cast(array() as array<{MATCH}>)")
    return let(found, lambda f: F.when(F.size(f) > 0, whole(f, F.split(text, pattern, -1))).otherwise(none))


def places(text, pattern, hint=None):
    """Matches of a pattern with their places, see ``placed``. A null text has none."""
    return F.coalesce(placed(text, pattern, matches(text, pattern, hint)), F.expr(f"cast(array() as array<{MATCH}>)"))


def bounds(spans):
    """Start and end alone, in order."""
    return F.array_sort(F.transform(spans, lambda x: F.struct(x.start.alias("start"), x.end.alias("end"))))


def gaps(ordered, empty=False):
    """What spans (``bounds``, which may overlap) leave of a text: disjoint stretches in order, the last without end.

    ``empty`` keeps the empty stretches before a first span at 0 and between spans that touch.
    """
    ends = running(F.transform(ordered, lambda x: x.end), F.greatest)
    before = F.concat(F.array(F.lit(0).cast("bigint")), ends)
    after = F.concat(F.transform(ordered, lambda x: x.start), F.array(F.lit(LAST)))
    both = F.zip_with(before, after, lambda a, b: F.struct(a.alias("start"), b.alias("end")))
    return F.filter(both, lambda x: x.start <= x.end if empty else x.start < x.end)


def _events(gaps_, spans):
    """Gaps and spans in order of their starts, a gap first: struct<start, kind (0: gap), at (place in its array), end>."""

    def marked(items, kind):
        event = lambda x, i: F.struct(x.start.alias("start"), F.lit(kind).alias("kind"), i.alias("at"), x.end.alias("end"))
        return F.transform(items, event)

    return F.array_sort(F.concat(marked(gaps_, 0), marked(spans, 1)))


def inside(spans, gaps_):
    """Whether each span, in any order, lies within a gap: array<boolean> in the order of the spans."""

    def found(events):
        ends = running(F.transform(events, lambda e: F.when(e.kind == 0, e.end).otherwise(F.lit(-1).cast("bigint"))), F.greatest, -1)
        marks = F.zip_with(events, ends, lambda e, end: F.struct(e.kind, e["at"], (e.end <= end).alias("ok")))
        own = F.array_sort(F.filter(marks, lambda m: m.kind == 1))
        return F.transform(own, lambda m: m.ok)

    return let(_events(gaps_, spans), found)


def outside(spans, covers):
    """The spans, which may overlap, that no cover touches."""
    flags = let(gaps(bounds(covers)), lambda free: inside(spans, free))
    kept = F.filter(F.arrays_zip(spans.alias("span"), flags.alias("ok")), lambda x: x.ok)
    return F.when(F.size(covers) == 0, spans).otherwise(F.transform(kept, lambda x: x.span))


def cut(spans, covers):
    """What covers leave of disjoint spans with values, in order: array<struct<start, end, value>>.

    A stretch begins where a span or a gap begins inside the other, so one pass over both, by start, finds all.
    """

    def pieces(own, free):
        def met(events):
            end_of = lambda kind: running(
                F.transform(events, lambda e: F.when(e.kind == kind, e.end).otherwise(F.lit(-1).cast("bigint"))), F.greatest, -1
            )
            last = running(
                F.transform(events, lambda e: F.when(e.kind == 1, e["at"].cast("bigint")).otherwise(F.lit(-1).cast("bigint"))),
                F.greatest,
                -1,
            )
            zipped = F.arrays_zip(events.alias("e"), end_of(0).alias("gap"), end_of(1).alias("span"), last.alias("at"))
            stretch = F.transform(
                zipped,
                lambda x: F.struct(
                    x.e.start.alias("start"), F.least(x["gap"], x.span).alias("end"), x["at"].cast("int").alias("at")
                ),
            )
            return F.transform(
                F.filter(stretch, lambda x: (x["at"] >= 0) & (x.start < x.end)),
                lambda x: let(
                    F.get(own, x["at"]),
                    lambda span: F.struct(
                        x.start.alias("start"),
                        x.end.alias("end"),
                        F.substring(span.value, (x.start - span.start + 1).cast("int"), (x.end - x.start).cast("int")).alias("value"),
                    ),
                ),
            )

        return let(_events(free, own), met)

    plain = lambda x: F.struct(x.start.alias("start"), x.end.alias("end"), x.value.alias("value"))
    covered = let(gaps(bounds(covers)), lambda free: pieces(spans, free))
    return F.when(F.size(covers) == 0, F.transform(spans, plain)).otherwise(covered)


def replaced(text, spans, mark):
    """The text with every stretch of overlapping spans (in any order) replaced by one mark; spans that only touch have a
    mark each. The text is cut into chunks once, so that a stretch is found without reading from the beginning."""

    def made(free, chunks, length):
        def own(x):
            end = F.least(x.end, length)
            first = (x.start / F.lit(TEXT_CHUNK)).cast("int")
            near = F.slice(chunks, first + 1, ((end - 1) / F.lit(TEXT_CHUNK)).cast("int") - first + 1)
            at = (x.start - first * TEXT_CHUNK + 1).cast("int")
            return F.when(x.start < end, F.substring(F.array_join(near, ""), at, (end - x.start).cast("int"))).otherwise("")

        return F.array_join(F.transform(free, own), mark)

    chunks = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % TEXT_CHUNK), F.lit(0))
    parts = F.struct(gaps(bounds(spans), True).alias("free"), chunks.alias("chunks"), F.length(text).cast("bigint").alias("length"))
    found = let(parts, lambda x: made(x.free, x.chunks, x.length))
    return F.when(F.size(spans) > 0, found).otherwise(text)
