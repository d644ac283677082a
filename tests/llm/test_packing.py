"""Packing: ids of the tokenizers library, the laws of the result, a plain model of best fit."""

import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer as Library

from stratalake.llm import packing
from stratalake.llm.packing import added_tokens, best_fit, cut, pack_documents, tokenizer
from stratalake.llm.registry import op10_packing

SF = "/root/testdata/sf0.001"
PATHS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def library():
    found = Library.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def check_laws(got: pd.DataFrame, docs: list[tuple], limit=2048):
    """Every piece is right and sequences are gapless."""
    encoded = library().encode_batch([t or "" for _, t in docs], add_special_tokens=False)
    expected = []
    for (doc_id, _), e in zip(docs, encoded, strict=True):
        ids = np.array(e.ids + [0], dtype="<u4")
        first = len(ids) if len(ids) <= limit else (len(ids) % limit or limit)
        bounds = [0, first, *range(first + limit, len(ids) + 1, limit)]
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            expected.append((doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    found = [tuple(None if pd.isna(x) else int(x) for x in r) for r in got[cols].values.tolist()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert seq.offset.tolist() == [0, *seq.length.cumsum().tolist()[:-1]]
        assert seq.length.sum() <= limit


def test_query_over_all_documents(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    got = op10_packing(spark, SF).toPandas()
    check_laws(got, docs[["doc_id", "text"]].values.tolist())
    assert got.sequence_id.nunique() <= 1.01 * got.length.sum() / 2048 + 1


def test_ids_are_those_of_the_library():
    ours, theirs = tokenizer(*PATHS), library()
    samples = [
        "", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a\n b", "a \n b", "a\n\n b", "\n", "it's 's",
        "x  y", "　 z", "don't  'll", "<|endoftext|> x", "é" * 5000, "日本語 text", "a\tb \t c",
        "1234 5678", "%%% *** ###", "😀 😀", "a" * 3000,
    ]
    rng = random.Random(5)
    samples += ["".join(rng.choices(" \n\ta'sé1. ", k=30)) for _ in range(500)]
    for text in samples:
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == theirs.encode(
            text, add_special_tokens=False
        ).ids, repr(text)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "x y"), (3, "word " * 5000), (3, "word " * 5000), (4, "a b " * 400)]
    schema = "doc_id long, text string"
    docs = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS piece", "2 AS bucket", "3 AS length")
    check_laws(pack_documents(docs, *PATHS).toPandas(), rows)
    assert pack_documents(spark.createDataFrame([], schema), *PATHS).collect() == []


def test_cut():
    assert cut(5, 5) == [(0, 5)] and cut(6, 5) == [(0, 1), (1, 5)]
    assert cut(10, 5) == [(0, 5), (5, 5)]


def test_best_fit_follows_the_rule():
    def model(lengths, capacity, limit):
        opened, out, made = [], [], 0
        for n in lengths:
            fits = [b for b in opened if b[1] >= n]
            if fits:
                b = min(fits, key=lambda b: b[1])
            else:
                if len(opened) >= limit:
                    opened.remove(min(opened, key=lambda b: b[1]))
                b = [made, capacity]
                opened.append(b)
                made += 1
            b[1] -= n
            out.append(capacity - b[1])
            if not b[1]:
                opened.remove(b)
        return made, out

    rng = random.Random(1)
    for limit in (1, 3, 50):
        lengths = [rng.randint(1, 100) for _ in range(500)]
        bins, offsets = best_fit(lengths, 100, limit)
        made, ends = model(lengths, 100, limit)
        assert max(bins) + 1 == made
        assert [o + n for o, n in zip(offsets, lengths)] == ends


def test_white_space_of_any_script_is_cut_as_the_library_cuts_it():
    ours, theirs = tokenizer(*PATHS), library()
    samples = ["a \xa0 \xa0 b", "a\xa0 ", "\n \n a", "a \u3000 \u2003 b", "x\xa0 y", "a\x85 \x85 b"]
    rng = random.Random(6)
    samples += ["".join(rng.choices("  \n\t\xa0\xa0\u3000a'sé1. ", k=30)) for _ in range(1000)]
    samples += ["".join(rng.choices(" \xa0a", k=12)).replace("  ", " ") for _ in range(1000)]
    for text in samples:
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == theirs.encode(
            text, add_special_tokens=False
        ).ids, repr(text)


def test_added_tokens_are_those_of_the_library_at_its_default(spark, tmp_path):
    json_path = public_tokenizers.path("byte_bpe_50k.json")
    ours, theirs = tokenizer(*PATHS, added_tokens(json_path)), Library.from_file(json_path)
    samples = [
        "<|endoftext|> x", "a <|endoftext|>", "a\xa0 <|endoftext|><|endoftext|>\n \n b", "<|endoftext|", "",
        "it <|endoftext|>'s", "x  <|endoftext|>  y",
    ]
    for text in samples:
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == ids, repr(text)
    assert theirs.encode(samples[0], add_special_tokens=False).ids == [50256, 2124]
    spark.createDataFrame([(1, samples[0])], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = op10_packing(spark, str(tmp_path)).first()
    assert (row.length, row.ids_crc32) == (3, zlib.crc32(np.array([50256, 2124, 0], "<u4").tobytes()))


def test_repeated_rows_are_spread_over_the_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "_GROUP_PIECES", 50)
    rows = [(None, None)] * 600 + [(7, "same text")] * 600
    got = pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), *PATHS).toPandas()
    check_laws(got, rows)
    sizes = (got.sequence_id.astype("int64") // 2**32).value_counts()
    assert len(sizes) > 12 and sizes.max() < 150
