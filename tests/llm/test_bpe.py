import gc
import hashlib

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from frames import CLASHES, documents
from mergelane.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PLAIN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = bpe.Encoder(RANKS, public_tokenizers.PATTERN, True)


def ids_of(packed):
    return [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)]


TEXTS = [
    "", " ", "a", "It's 12,345 o'clock.  Two  blanks\n\n and\ttabs  end ", "Grüße, naïve café — 東京 \U0001f600\U0001f600!",
    "x" * 3000, "ab" * 700 + " " + "7" * 500, "<|endoftext|>", "\x00\x1c\x1f a\x1cb", "​zero", "   lead", "trail   ",
    "aaaa aaa aa a", "the the the", "'S's 'll'd", "\r\n\r\n x", "é" * 300,
]


def test_like_tiktoken():
    for text, (ids, back) in zip(TEXTS, ENCODER(TEXTS)):
        assert ids_of(ids) == PLAIN.encode_ordinary(text), text[:40]
        assert back == text.encode()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'sé \n\t.,0 東\x1c\x85"), max_size=60), max_size=8))
def test_like_tiktoken_on_any_text(texts):
    for text, (ids, back) in zip(texts, ENCODER(texts)):
        assert ids_of(ids) == PLAIN.encode_ordinary(text)
        assert back == text.encode()


def test_rounds_of_long_pieces_agree():
    pieces = [("qu" * 90 + "etion" * 5).encode(), b"zq" * 99, "ſtreß".encode() * 20]
    short = ENCODER.coder.encode(pieces)
    old = bpe.LONG_PIECE
    bpe.LONG_PIECE = 1
    try:
        assert ENCODER.coder.encode(pieces) == short
    finally:
        bpe.LONG_PIECE = old


def test_cache_generations():
    small = bpe._Cache(3)
    for key in "abcdefgh":
        for k in small.missing({key, "a"}):
            small.ids[k], small.back[k] = k.encode(), k.encode()
        assert small.ids["a"] == b"a" and small.ids[key] == key.encode()
        assert len(small.ids) + len(small.old[0]) <= 10


def test_words_of_one_piece_share_its_pair():
    """Ids and bytes of a word are kept once, as a pair, and the search for cycles is as it was after a batch."""
    own = bpe.Encoder(RANKS, public_tokenizers.PATTERN, True)
    assert own(["one two's", ""]) == [(ENCODER(["one two's"])[0][0], b"one two's"), (b"", b"")]
    assert own.words.ids[" one"] is own.pieces.ids["one"] and not own.words.back
    assert gc.isenabled()


def test_rows(spark):
    texts = [None, "", "Hello hello world", "Hello hello world", "é" * 1000]
    docs = documents(spark, texts, [None, 1, 2, 2, 4], **CLASHES)
    coded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "ids", "decoded"]
    rows = sorted(((r.doc_id or -1), ids_of(r.ids), bytes(r.decoded)) for r in coded.collect())
    expected = [(i, PLAIN.encode_ordinary(t or ""), (t or "").encode()) for i, t in zip([-1, 1, 2, 2, 4], texts)]
    assert rows == expected
    back = bpe.decode(coded, RANKS)
    assert sorted((r.doc_id or -1, bytes(r.decoded)) for r in back.collect()) == [(i, d) for i, _, d in expected]
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    assert bpe.decode(coded.limit(0), RANKS).count() == 0


def test_query(spark):
    from mergelane.llm.queries import QUERIES, table

    folder = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in QUERIES["op6_byte_bpe"](spark, folder).collect()}
    docs = table(spark, folder, "documents").collect()
    assert len(found) == len(docs)
    for d in docs:
        ids = PLAIN.encode_ordinary(d.text or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        r = found[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
