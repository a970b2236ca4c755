import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from loanframe.llm.bpe import BytePairEncoder, decode_ids, encode_texts, read_ranks

PATH = P.path("byte_bpe_50k.tiktoken")
OURS = BytePairEncoder(read_ranks(PATH), P.PATTERN)
THEIRS = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=OURS.rank, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=200) | st.text("abcdeht ion\n'1", max_size=80))
def test_same_ids_as_the_merges(text):
    ids = OURS.encode(text)
    assert ids == THEIRS.encode_ordinary(text)
    assert OURS.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_000, "=" * 4097, "ab" * 5000, "é" * 3000, " " * 999 + "x"])
def test_long_single_matches(text):
    assert OURS.encode(text) == THEIRS.encode_ordinary(text)


def test_small_made_up_ranks_against_plain_merging():
    words = [b"ab", b"bc", b"abc", b"cd", b"bcd", b"aa", b"aaa", b"aaaa", b"dab"]
    lines = [base64.b64encode(bytes([i])) + b" %d" % i for i in range(256)]
    lines += [base64.b64encode(w) + b" %d" % (256 + i) for i, w in enumerate(words)]
    own = BytePairEncoder(b"\n".join(lines), r"\S+")
    ref = tiktoken.Encoding("small", pat_str=r"\S+", mergeable_ranks=own.rank, special_tokens={})
    import itertools

    for n in range(1, 8):
        for letters in itertools.product("abcd", repeat=n):
            text = "".join(letters)
            assert own.encode(text) == ref.encode_ordinary(text), text


def test_rank_file_must_hold_all_bytes():
    with pytest.raises(ValueError):
        BytePairEncoder(b"YQ== 0", r"\S+")


def test_columns_and_null_rows(spark):
    rows = [(1, "Hello wide world", "x"), (1, "Hello wide world", "x"), (None, None, None), (4, "", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    out = decode_ids(encode_texts(df, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert out[0].asDict().keys() == {"doc_id", "text", "ids", "decoded"}
    assert sorted((r.text or "", bytes(r.decoded)) for r in out) == sorted(
        (t or "", (t or "").encode()) for _, t, _ in rows
    )
    empty = encode_texts(df.filter("false"), PATH, P.PATTERN)
    assert empty.count() == 0


def test_query_digests(spark, tmp_path):
    from loanframe.llm.queries import op6_byte_bpe

    texts = [(1, "One two  three's\n\n4"), (2, None), (3, ""), (4, "漢\U0001f642 " * 50)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op6_byte_bpe(spark, str(tmp_path)).collect()}
    assert len(got) == 4
    for i, text in texts:
        ids = THEIRS.encode_ordinary(text or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
