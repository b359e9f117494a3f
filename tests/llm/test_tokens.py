import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from labflow.llm import queries_tokens, tokens
from labflow.llm.common import Scratch

ODD = [
    None,
    "",
    " ",
    "a",
    "  two  spaces ",
    "it's we'll 'tis",
    "line\nbreak\r\n\ttab \t mixed   fixed　wide",
    "\x1c\x1d control \x85 next line",
    "<|endoftext|> and <s> </s> <unk> <0x41>",
    "▁mark ▁▁ marks▁",
    "日本語のテキスト 한국어 ελληνικά עברית 😀👩‍👩‍👧",
    "x" * 5000,
    "ab1" * 30000,
    "word " * 40000,
    "́combining é",
    "\0null",
]


def texts():
    rng = random.Random(7)
    alphabet = "ab1'  \n\t  é中.,-▁<>|s"
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(150)]


@pytest.fixture(scope="module")
def docs(spark):
    # The second column clashes with what the operators add.
    return spark.createDataFrame(
        [(i, t, "x", 1) for i, t in enumerate(texts())], "doc_id long, text string, ids string, N_TOKENS int"
    ).repartition(3)


def test_round_trip_by_the_library(spark, docs):
    import tiktoken

    path = public_tokenizers.path(queries_tokens.ROUND_TRIP_RANKS)
    vocabulary = tokens.vocabulary(spark, path)
    expected = tokens._tiktoken("own", vocabulary.value[1], public_tokenizers.PATTERN)
    assert isinstance(expected, tiktoken.Encoding)
    encoded = tokens.encode(docs, vocabulary, public_tokenizers.PATTERN)
    got = tokens.decode(encoded, vocabulary).withColumn("digest", tokens.ids_digest(encoded.ids)).collect()
    for r in got:
        ids = expected.encode_ordinary(r.text or "")
        assert r.ids == ids
        assert r.digest == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert bytes(r.decoded) == (r.text or "").encode()


def merged(data, ranks):
    """Byte pair merges of one match by their definition, lowest rank and leftmost first, with a heap."""
    import heapq

    parts, after = [data[i : i + 1] for i in range(len(data))], list(range(1, len(data) + 1))
    before, alive = list(range(-1, len(data) - 1)), [True] * len(data)
    heap = [(ranks[data[i : i + 2]], i, data[i : i + 2]) for i in range(len(data) - 1) if data[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, both = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= len(data) or parts[i] + parts[j] != both:
            continue
        parts[i], alive[j], after[i] = both, False, after[j]
        if after[j] < len(data):
            before[after[j]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] < len(data) and parts[a] + parts[after[a]] in ranks:
                pair = parts[a] + parts[after[a]]
                heapq.heappush(heap, (ranks[pair], a, pair))
    return [ranks[p] for p, ok in zip(parts, alive) if ok]


SPACES = {"spaces": " ", "lines": "\n", "mixed": " \n\t\r\n  \u3000"}


@pytest.mark.parametrize("kind", list(SPACES))
def test_long_runs_of_white_space(spark, kind):
    """By the definition of the merges, and, for packing and counting, by the tokenizers library."""
    from tokenizers import Tokenizer

    unit = SPACES[kind]
    run = lambda n: unit * (n // len(unit))
    texts = [run(1_000_000), "a" + run(1_200_000) + "word b", run(90_000) + "x" + run(70_000) + "9" + run(1 << 16)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    vocabulary = tokens.vocabulary(spark, public_tokenizers.path(queries_tokens.ROUND_TRIP_RANKS))
    encoding = tokens._tiktoken("own", vocabulary.value[1], public_tokenizers.PATTERN)
    got = {r.doc_id: r for r in tokens.decode(tokens.encode(docs, vocabulary, public_tokenizers.PATTERN), vocabulary).collect()}
    ranks = encoding._mergeable_ranks
    assert got[0].ids == merged(texts[0].encode(), ranks)
    tail = texts[1][len(texts[1]) - len("word b") - 1 :]
    expected = encoding.encode_ordinary("a") + merged(texts[1][1 : -len(tail)].encode(), ranks) + encoding.encode_ordinary(tail)
    assert got[1].ids == expected
    assert got[2].ids == encoding.encode_ordinary(texts[2])
    assert all(bytes(got[i].decoded) == t.encode() for i, t in enumerate(texts))

    path = public_tokenizers.path(queries_tokens.PACK_MODEL)
    model = Tokenizer.from_file(path)
    library = [model.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    packed = tokens.pack(docs, tokens.vocabulary(spark, path), pattern=public_tokenizers.PATTERN)
    packed = packed.select("doc_id", "start", "ids").collect()
    for i, ids in enumerate(library):
        own = sorted((r for r in packed if r.doc_id == i), key=lambda r: r.start)
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in own]).tolist() == ids
    counted = tokens.count_tokens(docs, tokens.vocabulary(spark, path), "tokenizers").collect()
    assert {r.doc_id: r.n_tokens + 1 for r in counted} == {i: len(ids) for i, ids in enumerate(library)}


def test_ten_million_spaces(spark):
    docs = spark.createDataFrame([(0, "a" + " " * 10_000_000 + "b")], "doc_id long, text string")
    vocabulary = tokens.vocabulary(spark, public_tokenizers.path(queries_tokens.ROUND_TRIP_RANKS))
    r = tokens.decode(tokens.encode(docs, vocabulary, public_tokenizers.PATTERN), vocabulary).selectExpr("length(decoded) n").first()
    assert r.n == 10_000_002
    path = public_tokenizers.path(queries_tokens.PACK_MODEL)
    packed = tokens.pack(docs, tokens.vocabulary(spark, path), pattern=public_tokenizers.PATTERN)
    last = packed.selectExpr("max(doc_tokens) n", "sum(length) m").first()
    assert last.n == last.m == tokens.count_tokens(docs, tokens.vocabulary(spark, path), "tokenizers").first().n_tokens + 1


def test_pieces_of_long_texts_change_no_id(spark):
    vocabulary = tokens.vocabulary(spark, public_tokenizers.path(queries_tokens.ROUND_TRIP_RANKS))
    encoding = tokens._tiktoken("own", vocabulary.value[1], public_tokenizers.PATTERN)
    for t in filter(None, texts()):
        pieces = list(tokens.safe_pieces(t, 5))
        assert "".join(pieces) == t
        assert sum((encoding.encode_ordinary(p) for p in pieces), []) == encoding.encode_ordinary(t)


def test_decode_keeps_bytes_that_are_no_text(spark):
    vocabulary = tokens.vocabulary(spark, public_tokenizers.path(queries_tokens.ROUND_TRIP_RANKS))
    encoding = tokens._tiktoken("own", vocabulary.value[1], public_tokenizers.PATTERN)
    one = encoding.encode_single_token(b"\xe6")
    got = tokens.decode(spark.createDataFrame([([one],), (None,), ([],)], "ids array<int>"), vocabulary).collect()
    assert [r.decoded if r.decoded is None else bytes(r.decoded) for r in got] == [b"\xe6", None, b""]


@pytest.mark.parametrize("kind,name", [("sentencepiece", queries_tokens.COUNT_MODEL), ("tokenizers", "byte_bpe_50k.json")])
def test_counts_by_the_library(spark, docs, kind, name):
    path = public_tokenizers.path(name)
    if kind == "sentencepiece":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        expected = lambda t: len(model.encode(t))
    else:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        expected = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    got = tokens.count_tokens(docs, tokens.vocabulary(spark, path), kind).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: expected(t or "") for i, t in enumerate(texts())}


@pytest.mark.parametrize("pattern", [None, public_tokenizers.PATTERN])
def test_packing(spark, docs, pattern):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries_tokens.PACK_MODEL)
    model = Tokenizer.from_file(path)
    got = tokens.pack(docs, tokens.vocabulary(spark, path), longest=64, pattern=pattern).collect()
    assert len({r.sequence_id for r in got}) == len(got)
    for i, t in enumerate(texts()):
        ids = model.encode(t or "", add_special_tokens=False).ids + [0]
        own = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        assert sum((np.frombuffer(r.ids, "<u4").tolist() for r in own), []) == ids
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert all(r.length == 1 << r.bucket <= 64 and r.offset == 0 and r.doc_tokens == len(ids) for r in own)


def test_merges_are_those_of_the_vocabulary():
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(queries_tokens.PACK_MODEL), "rb") as f:
        data = f.read()
    model, merges = Tokenizer.from_buffer(data), tokens._merges(data, public_tokenizers.PATTERN)[0]
    rng = random.Random(1)
    letters = " \nabcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789àéîõüßñœ.,;:!?'\"()=/_+-<|>#$%&@{}"
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 60))) for _ in range(3000)]
    assert all(tokens.LATIN.fullmatch(w) for w in words)
    found = model.encode_batch(words, add_special_tokens=False)
    assert [merges.encode_ordinary(w) for w in words] == [x.ids for x in found]


def test_pieces_are_the_binary_digits():
    assert tokens.binary_pieces(2051, 1024) == [1024, 1024, 2, 1]
    assert tokens.binary_pieces(1, 1024) == [1]
    assert all(sum(tokens.binary_pieces(n, 16)) == n for n in range(200))


def test_longest_must_be_a_power_of_two(docs):
    with pytest.raises(ValueError):
        tokens.pack(docs, None, longest=1000)


def test_empty_table_and_query_digests(spark, docs, tmp_path):
    folder = str(tmp_path)
    docs.limit(0).write.parquet(f"{folder}/none/documents.parquet")
    docs.write.parquet(f"{folder}/some/documents.parquet")
    for query in (queries_tokens.op3_bpe_round_trip, queries_tokens.op7_binary_pieces, queries_tokens.op9_token_counts):
        assert query(spark, f"{folder}/none").count() == 0
    piece = next(r for r in queries_tokens.op7_binary_pieces(spark, f"{folder}/some").collect() if r.doc_id == 0)
    assert (piece.length, piece.ids_crc32) == (1, zlib.crc32(b"\0\0\0\0"))
    counted = {r.doc_id: r for r in queries_tokens.op9_token_counts(spark, f"{folder}/some").collect()}
    assert counted[13].over_limit and counted[0].n_bytes == 0 and not counted[0].over_limit


def test_each_pre_token_is_counted_once(spark, monkeypatch):
    """Small blocks give the same counts, and the model sees every distinct pre-token one time."""
    monkeypatch.setattr(tokens, "BLOCK_CHARS", 2000)
    monkeypatch.setattr(tokens, "BLOCK_ROWS", 4)
    monkeypatch.setattr(tokens, "LEAST_BUCKETS", 3)
    monkeypatch.setattr(tokens, "DEALT_ROWS", 2)
    rows = [(i, "the same words, mostly " * 30 + f"end{i % 7}", "c", i) for i in range(60)] + [(None, None, "x", 1)] * 2
    rows += [(i, "", None, None) for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, block string, n int").repartition(5)
    vocabulary = tokens.vocabulary(spark, public_tokenizers.path(queries_tokens.COUNT_MODEL))
    scratch = Scratch(spark, "counted")
    got = tokens.count_tokens(frame, vocabulary, "sentencepiece", scratch=scratch)
    assert got.columns == ["doc_id", "text", "block", "n", "n_tokens"]
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=vocabulary.value[1])
    expected = sorted((str(r[:1] + r[2:]), len(model.encode(r[1] or ""))) for r in rows)
    assert sorted((str((r.doc_id, r.block, r.n)), r.n_tokens) for r in got.collect()) == expected
    narrow = tokens.count_tokens(frame, vocabulary, "sentencepiece", out="N", keep=["doc_id", "n"])
    assert narrow.columns == ["doc_id", "N"] and narrow.count() == len(rows)
    scratch.clear()
    seen = spark.sparkContext.accumulator(0)

    def counter(*_):
        def count(words):
            seen.add(len(words))
            return [len(w) for w in words]

        return count

    monkeypatch.setattr(tokens, "_once", lambda key, make: counter())
    lists = [(i, ["a", "bc", "é\0" * 9, f"own{i}"][i % 2 :]) for i in range(50)] + [(99, [])]
    frame = spark.createDataFrame(lists, "home long, listed array<string>").repartition(7)
    got = {i: {} for i, _ in lists}
    for r in tokens.pre_token_counts(frame, vocabulary, "sentencepiece", 5).collect():
        got[r.home].update(zip(*(x.tolist() for x in tokens._unpacked(r.counts))))
    assert got == {i: {k: len(w) for k, w in enumerate(words)} for i, words in lists} and seen.value == 53


def test_packed_frequencies():
    for places, times in (([], []), ([0], [1]), ([70000, 3, 255, 256], [1, 1 << 31, 2, 300])):
        order = np.argsort(np.array(places, int))
        got = tokens._unpacked(tokens._packed(places, times))
        assert [x.tolist() for x in got] == [np.array(x, int)[order].tolist() for x in (places, times)]
