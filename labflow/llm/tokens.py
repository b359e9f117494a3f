"""Byte-level BPE encoding and decoding, token counts and packing by the vocabularies of public tokenizers.

The vocabulary file is read once, on the driver, and broadcast as bytes: a vocabulary file has a fixed size of a few
megabytes that does not depend on the data.
"""

import base64
import hashlib
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labflow.llm.common import BoundedCache, Scratch, ship_package, slices, with_columns

# Characters that every splitting pattern takes for white space.
SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A space after something else always starts a new match, so texts may be cut there without changing any id.
SAFE_PIECE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
SAFE_CUT = re.compile(f"(?<=[^{SPACE}])[{SPACE}]")

# Runs of white space from this length on go round the splitting pattern, whose engine looks back over a run by
# recursion and breaks off at about a million characters.
LONG_RUN = 1 << 16
SPACE_RUN = re.compile(f"[{SPACE}]{{{LONG_RUN},}}")
# A pattern that takes any text whole.
WHOLE = r"(?s:.+)"

PIECE_CHARS = 1 << 16
SLICE_CHARS = 4 << 20
# Documents that share a list of pre-tokens: the more, the fewer rows there are for a pre-token.
BLOCK_CHARS, BLOCK_ROWS = 16 << 20, 100_000
LEAST_BUCKETS = 64
# Packed lists that are handed on at a time.
DEALT_ROWS = 1000
CACHED = 200_000
# Texts of characters that every version of the splitting pattern sorts alike.
LATIN = re.compile("[\n\x20-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]*")
_loaded = {}


def vocabulary(spark, path):
    """A vocabulary file as a broadcast (name, bytes)."""
    with open(path, "rb") as f:
        data = f.read()
    return spark.sparkContext.broadcast((hashlib.sha256(data).hexdigest(), data))


def _once(key, make):
    """One encoder or cache of a kind per worker process."""
    if key not in _loaded:
        _loaded[key] = make()
    return _loaded[key]


def _texts(array):
    return [x or "" for x in array.to_pylist()]


# ---- encoding and decoding ------------------------------------------------------------------------------------


def _tiktoken(name, data, pattern):
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}
    return tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text, size=PIECE_CHARS):
    """Cut a long text before a white space that follows something else.

    No match of the splitting pattern crosses such a place and none looks behind it, so the ids of the pieces in a row
    are those of the whole. A stretch without such a place stays in one piece.
    """
    start = 0
    while len(text) - start > size:
        cut = SAFE_CUT.search(text, start + size)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def _ordinary(text, encoding, whole):
    """Lists of ids that make up those of the whole text, whatever its length.

    The pattern takes a run of white space as one match, up to its last character if something follows: that character
    belongs to what follows. ``whole`` gives the engine that takes a text for one match.
    """
    for piece in safe_pieces(text):
        start = 0
        for run in SPACE_RUN.finditer(piece) if len(piece) >= LONG_RUN else ():
            end = run.end() - (run.end() < len(piece))
            if run.start() > start:
                yield encoding.encode_ordinary(piece[start : run.start()])
            yield whole().encode_ordinary(piece[run.start() : end])
            start = end
        if start < len(piece):
            yield encoding.encode_ordinary(piece[start:])


def encode(docs, vocabulary, pattern, text="text", out="ids"):
    """Add ``out``: the ids of each whole text as array<int>, special tokens' strings being ordinary text.

    A null text counts as empty and an empty text has no ids. Very long texts and runs of any character are encoded whole.
    Repeated rows each have their result. A column already called ``out`` is replaced.
    """
    ship_package(docs.sparkSession)

    @F.arrow_udf("array<int>")
    def ids(batch: pa.Array) -> pa.Array:
        name, data = vocabulary.value
        encoding = _once(("encode", name, pattern), lambda: _tiktoken(name, data, pattern))
        whole = lambda: _once(("encode", name, WHOLE), lambda: _tiktoken(name, data, WHOLE))
        texts, found = _texts(batch), []
        for first, last in slices([len(t) for t in texts], SLICE_CHARS):
            rows = []
            for t in texts[first:last]:
                own = []
                for ids in _ordinary(t, encoding, whole):
                    own += ids
                rows.append(own)
            found.append(pa.array(rows, pa.list_(pa.int32())))
        return pa.concat_arrays(found) if found else pa.array([], pa.list_(pa.int32()))

    return with_columns(docs, {out: ids(F.col(f"`{text}`"))})


def decode(docs, vocabulary, ids="ids", out="decoded"):
    """Add ``out``: the raw bytes that the ids stand for (binary; null for null ids).

    Bytes need not be valid UTF-8, as a run of ids may end inside a character.
    """
    ship_package(docs.sparkSession)

    @F.arrow_udf("binary")
    def raw(batch: pa.Array) -> pa.Array:
        name, data = vocabulary.value
        encoding = _once(("decode", name), lambda: _tiktoken(name, data, "."))
        return pa.array(
            [encoding.decode_bytes(x.values.to_pylist()) if x.is_valid else None for x in batch], pa.binary()
        )

    return with_columns(docs, {out: raw(F.col(f"`{ids}`"))})


def ids_digest(ids):
    """Lowercase hex SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(F.transform(ids, lambda x: x.cast("string")), ",").cast("binary"), 256)


# ---- counts ---------------------------------------------------------------------------------------------------


def _counter(name, data, kind):
    """A function from a list of pre-tokens to the number of tokens of each."""
    if kind == "sentencepiece":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        # An empty text has no tokens, so a space alone is counted behind a letter.
        alone = len(model.encode("a ")) - len(model.encode("a"))

        def count(words):
            # The model puts one space before what it is given, which stands for the pre-token's own first space.
            found = model.encode([w[1:] for w in words], num_threads=1)
            return [len(x) if w != " " else alone for w, x in zip(words, found)]

        return count
    from tokenizers import Tokenizer

    model = Tokenizer.from_buffer(data)
    return lambda words: [len(x) for x in model.encode_batch_fast(words, add_special_tokens=False)]


# A run of spaces and what follows up to the next space: no piece of the model has a space after another character.
SPACED = re.compile(" +[^ ]*")


def pre_tokens(text, kind):
    """Parts of a text that the model encodes independently of each other."""
    if kind == "sentencepiece":
        # The model takes its own space mark for a space.
        return SPACED.findall(" " + text.replace("▁", " ")) if text else []
    return SAFE_PIECE.findall(text)


def count_tokens(docs, vocabulary, kind, text="text", out="n_tokens", keep=None, scratch=None):
    """Add ``out``: the number of tokens of each whole text (bigint; 0 for null and empty texts).

    Every distinct pre-token of the table is counted once by the model, and its count joined to the documents' pre-token
    frequencies, which are summed. No ids leave the model's task.

    1. Rows are taken in blocks of about ``BLOCK_CHARS`` characters. A block has a list of its distinct pre-tokens, and a
       document is places in that list with their frequencies, as packed bytes.
    2. The lists are dealt to buckets by a hash of the pre-token, packed, one row for each block and bucket. There are as
       many buckets as blocks, so a bucket holds about as many rows of pre-tokens as a list, and a hot pre-token is one
       of them for each block. The model counts each distinct pre-token of a bucket once; the rows go back as counts.
    3. Every block meets its counts and sums them for each of its documents.

    ``keep``: the columns of ``docs`` to return (all if not given; the text then goes through the shuffle too). One called
    ``out`` in any case gives way. Repeated rows each have their result. Tables are written to ``scratch``, which
    the caller may clear once the result has been read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = scratch or Scratch(spark, "counts")
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() != out.lower()]
    # Names of our own while the rows are on their way, so that none clashes.
    own = docs.select(F.col(f"`{text}`").alias("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    rest = T.StructType([T.StructField(f.name, f.dataType) for f in own.schema.fields[1:]])
    block = T.StructType.fromDDL("block bigint, listed array<string>, packed binary")
    taken = T.StructType(block.fields + rest.fields)
    table, _ = scratch.table(own.mapInArrow(lambda batches: _frequencies(batches, kind, rest.names), taken), "zstd")
    lists = table.where("listed IS NOT NULL").select(F.col("block").alias("home"), "listed")
    known = pre_token_counts(lists, vocabulary, kind, max(LEAST_BUCKETS, lists.count()))
    result = T.StructType(rest.fields + [T.StructField("n", T.LongType())])
    summed = (
        table.where("listed IS NULL")
        .select("block", "packed", *rest.names)
        .groupBy("block")
        .cogroup(known.groupBy("home"))
        .applyInArrow(lambda rows, counts: _summed(rows, counts, rest.names), result)
    )
    return summed.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.col("n").alias(out))


def pre_token_counts(lists, vocabulary, kind, buckets):
    """How many tokens the model makes of every pre-token of (home, listed): rows (home, packed places and counts).

    One shuffle brings equal pre-tokens together, which are counted once.
    """
    ship_package(lists.sparkSession)

    def counted(batches):
        name, data = vocabulary.value
        count = _once(("count", name, kind), lambda: _counter(name, data, kind))
        bucket, rows = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "home", "places", "words"))):
                if row[0] != bucket and rows:
                    yield _counts_of(rows, count)
                    rows = []
                bucket = row[0]
                rows.append(row[1:])
        if rows:
            yield _counts_of(rows, count)

    dealt = lists.mapInArrow(lambda batches: _dealt(batches, buckets), "bucket bigint, home bigint, places binary, words binary")
    met = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(counted, "home bigint, counts binary")


def _dealt(batches, buckets):
    """Each list in packed parts, one for each bucket that it has pre-tokens of."""
    for batch in batches:
        for home, listed in zip(batch.column("home").to_pylist(), batch.column("listed")):
            words = [w.encode() for w in listed.values.to_pylist()]
            if not words:
                continue
            number = np.fromiter(map(zlib.crc32, words), "i8", len(words)) % buckets
            order = np.argsort(number, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(number[order]) != 0])
            parts = np.split(order, starts[1:])
            for first in range(0, len(parts), DEALT_ROWS):
                some = parts[first : first + DEALT_ROWS]
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([int(number[x[0]]) for x in some], pa.int64()),
                        "home": pa.array([home] * len(some), pa.int64()),
                        "places": pa.array([_packed(x, np.zeros(len(x))) for x in some], pa.binary()),
                        "words": pa.array([_packed_words([words[i] for i in x]) for x in some], pa.binary()),
                    }
                )


def _packed_words(words):
    """Lengths and bytes of words, compressed."""
    lengths = np.array([len(w) for w in words], "<u4").view("u1").reshape(-1, 4).T.tobytes()
    return len(words).to_bytes(4, "little") + zlib.compress(lengths + b"".join(words), 1)


def _unpacked_words(packed):
    n = int.from_bytes(packed[:4], "little")
    raw = zlib.decompress(packed[4:])
    lengths = np.frombuffer(raw, "u1", 4 * n).reshape(4, n).T.copy().view("<u4")[:, 0]
    ends = 4 * n + np.r_[0, np.cumsum(lengths, dtype="i8")]
    return [raw[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]


def _counts_of(rows, count):
    """The rows (home, places, words) of a bucket with counts in place of the words."""
    number, at = {}, []
    for _, _, words in rows:
        at.append([number.setdefault(w, len(number)) for w in _unpacked_words(words)])
    words, n = [w.decode() for w in number], []
    for first, last in slices([len(w) for w in words], SLICE_CHARS):
        n += count(words[first:last])
    n = np.array(n, "i8")
    made = [_packed(_unpacked(places)[0], n[own]) for (_, places, _), own in zip(rows, at)]
    return pa.RecordBatch.from_pydict(
        {"home": pa.array([r[0] for r in rows], pa.int64()), "counts": pa.array(made, pa.binary())}
    )


def _frequencies(batches, kind, others):
    """Blocks of rows: one row that lists the block's distinct pre-tokens, and one for each document.

    Numbers of blocks hold in the written table only, where each task's rows come from one attempt.
    """
    from collections import Counter

    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32
    number, packed, held, chars = {}, [], [], 0

    def rows():
        made = {
            "block": pa.array([block] * (len(packed) + 1), pa.int64()),
            "listed": pa.array([None] * len(packed) + [list(number)], pa.list_(pa.string())),
            "packed": pa.array(packed + [None], pa.binary()),
        }
        at = pa.array([*range(len(packed)), None], pa.int64())
        return pa.RecordBatch.from_pydict(
            made | {c: pa.concat_arrays([part.column(c) for part in held]).take(at) for c in others}
        )

    for batch in batches:
        start = 0
        for i, t in enumerate(_texts(batch.column("text"))):
            if packed and (chars + len(t) > BLOCK_CHARS or len(packed) >= BLOCK_ROWS):
                held.append(batch.slice(start, i - start))
                yield rows()
                number, packed, held, chars, start = {}, [], [], 0, i
                block += 1
            own = Counter(pre_tokens(t, kind))
            packed.append(_packed([number.setdefault(w, len(number)) for w in own], list(own.values())))
            chars += len(t)
        held.append(batch.slice(start))
    if packed:
        yield rows()


def _packed(places, times):
    """Places, ascending and as differences, and frequencies; bytes of equal rank lie together, so they compress well."""
    places, times = np.array(places, "i8"), np.array(times, "<u4")
    order = np.argsort(places)
    steps = np.diff(places[order], prepend=0).astype("<u4")
    return np.stack([steps, times[order]], 1).view("u1").reshape(len(places), 8).T.tobytes()


def _unpacked(packed):
    steps, times = np.frombuffer(packed, "u1").reshape(8, -1).T.copy().view("<u4").T
    return np.cumsum(steps, dtype="i8"), times.astype("i8")


def _summed(rows, counts, others):
    """Sums of counts times frequencies for the documents of one block."""
    known = [_unpacked(x.as_py()) for x in counts["counts"]]
    by_place = np.zeros(max((int(place[-1]) + 1 for place, _ in known), default=1), "i8")
    for place, n in known:
        by_place[place] = n
    sums = []
    for packed in rows["packed"]:
        places, times = _unpacked(packed.as_py())
        sums.append(int(by_place[places] @ times))
    return pa.table({c: rows[c] for c in others} | {"n": pa.array(sums, pa.int64())})


# ---- packing --------------------------------------------------------------------------------------------------


def binary_pieces(n, longest):
    """Lengths of the pieces of n tokens: as many of the longest as fit, then the powers of two that make the rest."""
    pieces = [longest] * (n // longest)
    rest = n % longest
    bit = longest >> 1
    while bit:
        if rest & bit:
            pieces.append(bit)
        bit >>= 1
    return pieces


def pack(docs, vocabulary, longest=1024, end_id=0, text="text", pattern=None):
    """Split every document into pieces whose lengths are powers of two; each piece is a sequence of its own.

    Rows of the result are the input's columns and, per piece: ``start`` (ids of the document before it), ``length``,
    ``ids`` (little-endian unsigned 32-bit ids as binary), ``doc_tokens`` (with the closing ``end_id``), ``bucket``
    (log2 of the length: equal lengths make a batch without padding), ``sequence_id`` (unique) and ``offset`` (always
    0, as no sequence holds two documents). The input's columns of those names give way.

    A null or empty text is one piece that holds only the closing id. ``longest`` must be a power of two. Ids are those
    of the tokenizers library for the whole text: texts are cut at places that no match of its pattern crosses, and
    equal parts are encoded once per worker as long as a bounded cache holds them. With the vocabulary's splitting
    ``pattern``, texts of Latin letters go through the same merges in a faster engine, with the same ids.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    ship_package(docs.sparkSession)

    @F.arrow_udf("array<struct<start: bigint, length: bigint, ids: binary, doc_tokens: bigint>>")
    def pieces(batch: pa.Array) -> pa.Array:
        from tokenizers import Tokenizer

        name, data = vocabulary.value
        model = _once(("pack", name), lambda: Tokenizer.from_buffer(data))
        merges = pattern and _once(("merges", name, pattern), lambda: _merges(data, pattern))
        whole = lambda: _once(("merges", name, WHOLE), lambda: _merges(data, WHOLE)[0])
        known = _once(("packed", name), lambda: BoundedCache(CACHED))
        kind = pa.list_(
            pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())])
        )
        end = int(end_id).to_bytes(4, "little")
        texts = _texts(batch)
        rows = []
        for first, last in slices([len(t) for t in texts], SLICE_CHARS):
            for raw in _encoded(texts[first:last], model, merges, whole, known):
                raw += end
                n, start, own = len(raw) // 4, 0, []
                for length in binary_pieces(n, longest):
                    own.append((start, length, raw[4 * start : 4 * (start + length)], n))
                    start += length
                rows.append([dict(zip(("start", "length", "ids", "doc_tokens"), x)) for x in own])
        return pa.array(rows, kind)

    made = ["start", "length", "ids", "doc_tokens"]
    taken = {*made, "bucket", "sequence_id", "offset", "_piece"}
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken]
    return (
        docs.select(*kept, F.explode(pieces(F.col(f"`{text}`"))).alias("_piece"))
        .select(*kept, *[F.col(f"_piece.{c}").alias(c) for c in made])
        .withColumn("bucket", F.log2(F.col("length").cast("double")).cast("int"))
        .withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("bigint"))
    )


def _encoded(texts, model, merges, whole, known):
    """Ids of each text as little-endian 32-bit words (the machine's own order is taken to be that)."""
    found = [None] * len(texts)
    if merges:
        engine, special = merges
        for i, t in enumerate(texts):
            if LATIN.fullmatch(t) and not any(x in t for x in special):
                found[i] = b"".join(array("I", ids).tobytes() for ids in _ordinary(t, engine, whole))
    parts = {i: SAFE_PIECE.findall(texts[i]) for i, x in enumerate(found) if x is None}
    words = set().union(*parts.values())
    new = words - known.keys()
    known.room_for(new, words)
    new = list(new)
    for first, last in slices([len(w) for w in new], SLICE_CHARS):
        ids = model.encode_batch_fast(new[first:last], add_special_tokens=False)
        known.update((w, array("I", x.ids).tobytes()) for w, x in zip(new[first:last], ids))
    for i, own in parts.items():
        found[i] = b"".join(map(known.__getitem__, own))
    return found


def _byte_letters():
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _merges(data, pattern):
    """(the same merges in a faster engine, special tokens), or None if the ids are not in the order of the merges."""
    import json

    import tiktoken

    described = json.loads(data)
    model = described["model"]
    letters = _byte_letters()
    special = {t["content"] for t in described.get("added_tokens", [])}
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    in_order = all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs))
    bytewise = sorted(i for t, i in vocab.items() if len(t) == 1) == list(range(256))
    if not (in_order and bytewise and len(vocab) == 256 + len(pairs) and described["pre_tokenizer"]["type"] == "ByteLevel"):
        return None
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items()}
    return tiktoken.Encoding("merges", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sorted(special)
