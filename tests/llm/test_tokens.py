"""Token files, counts and packing against the libraries on whole texts."""

from __future__ import annotations

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from presskiln.llm import common
from presskiln.llm.common import filesystem, releasing, shared_folder, ship
from presskiln.llm.packing import Packer, pack
from presskiln.llm.token_counts import count_tokens
from presskiln.llm.token_files import TokenReader, read_token_files, write_token_files
from presskiln.llm.tokens import ByteEncoder, WordEncoder, encoder

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "  a  b ", "a\n b", "a \nb\n\n c", "don't 've  it's", "x y z", "　 　q",
    "é ́e", "<|endoftext|> a<|endoftext|>b <s> </s>", "▁a ▁ b▁", "\U0001f600 \U0001f600x", "\x00\x1c a\x1d b", "ΑΣ Σ ΑΣ", "12 345  6",
    "tab\t x\t\ty", "word " * 30000, "x" * 3000,
]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    ties = spark.createDataFrame([(3, "tie one"), (3, "tie two"), (3, "tie two"), (None, "no id")], "doc_id long, text string")
    return real.union(odd).union(ties).withColumn("start", F.lit("clash")).withColumn("ids", F.lit(1)).repartition(5)


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_hold_the_library_ids(spark, docs):
    library = Tokenizer.from_file(BYTES)
    files = write_token_files(docs, BYTES, shared_folder(spark, "tokens"))
    back = [tuple(r) for r in read_token_files(files, with_ids=False).collect()]
    assert all(r["ids_crc32"] == _crc(np.frombuffer(r["ids"], "<u2")) for r in read_token_files(files).collect())
    expected = {}
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        expected.setdefault(r["doc_id"], []).append((len(ids), _crc(ids)))
    found, start = {}, 0
    for doc_id, begin, n, crc in sorted(back, key=lambda r: r[1]):
        assert begin == start
        start += n
        found.setdefault(doc_id, []).append((n, crc))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    keys = [-1 if k is None else k for k in found]
    assert keys == sorted(keys)


def test_reader_takes_only_the_frames_it_needs(spark, docs):
    files = write_token_files(docs, BYTES, shared_folder(spark, "tokens"))
    row = files.where("n_docs > 2").first()
    store, path = filesystem(row["path"])
    with store.open_input_file(path) as file:
        reader = TokenReader(file, row["bytes"])
        wanted = int(reader.doc_ids[-1])
        read = []
        frame = reader.frame
        reader.frame = lambda k: read.append(k) or frame(k)
        assert list(reader.find([wanted])) == [wanted]
        assert len(read) == len(set(read)) <= 2
    data = bytearray(open(path, "rb").read())
    data[int(reader.starts[0]) + 12] ^= 1
    import io

    import zstandard

    with pytest.raises((ValueError, zstandard.ZstdError)):
        TokenReader(io.BytesIO(data), len(data)).frame(0)


def test_counts_are_those_of_the_library(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = []
    for r in docs.collect():
        text = r["text"] or ""
        n = len(library.encode(text))
        expected.append((r["doc_id"], len(text.encode()), n, n > 4096))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, count_tokens(docs, PIECES).collect()), key=key) == sorted(expected, key=key)


def test_packed_pieces_cover_every_document_once(spark, docs):
    library = Tokenizer.from_file(WORDS)
    rows = pack(docs, WORDS).collect()
    expected = {}
    for r in docs.where("doc_id is not null and doc_id <> 3").collect():
        expected[r["doc_id"]] = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
    pieces, sequences = {}, {}
    for r in rows:
        assert r["ids_crc32"] == _crc(np.frombuffer(r["ids"], "<u2"))
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for doc_id, ids in expected.items():
        own = sorted(pieces[doc_id], key=lambda r: r["start"])
        assert b"".join(r["ids"] for r in own) == np.array(ids, "<u2").tobytes()
        assert {r["doc_tokens"] for r in own} == {len(ids)}
    assert len(pieces[3]) == 4 and len(pieces[None]) == 1
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096
    used = sum(r["length"] for r in rows)
    assert len(sequences) <= used / 4096 * 1.05 + 1


def test_packer_takes_the_best_window_and_gives_out_the_fullest():
    packer = Packer(size=10, open_windows=2)
    assert packer.add(("a",), 6) is None
    assert packer.add(("b",), 7) is None
    assert packer.add(("c",), 3) == [("b",), ("c",)]
    assert packer.add(("d",), 5) is None
    assert packer.add(("e",), 6) == [("a",)]
    assert list(packer.close()) == [[("d",)], [("e",)]]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert read_token_files(write_token_files(none, BYTES, shared_folder(spark, "tokens"))).count() == 0
    assert count_tokens(none, PIECES).count() == 0
    assert pack(none, WORDS).count() == 0


def test_files_are_in_the_shared_folder(spark):
    assert glob.glob(spark.conf.get("spark.checkpoint.dir") + "/tokens-*")


@pytest.mark.parametrize(("kind", "path"), [(ByteEncoder, BYTES), (WordEncoder, WORDS)])
def test_plain_words_go_to_the_model_and_have_the_library_ids(kind, path):
    rng, letters = random.Random(3), [c for c in map(chr, range(65, 256)) if c.isalpha() and c not in "ªµº"]
    words = ["".join(rng.choices(letters, k=rng.randint(1, 14))) for _ in range(3000)]
    words += ["".join(rng.choices("abcdeIStn", k=rng.randint(1, 9))) for _ in range(3000)]
    words += [w + end for w in words[:300] for end in (".", "!", "'s", "ªb", "µ", "3", "***", "İ", "ǰ", "J̌", "́")]
    rng.shuffle(words)
    texts = [" ".join(words[k : k + 40]) for k in range(0, len(words), 40)] + ODD[1:] + ["<|ENDOFTEXT|> a", "A\xa0B\x85C"]
    library = Tokenizer.from_file(path)
    expected = [np.array(library.encode(t, add_special_tokens=False).ids, np.uint16).tobytes() for t in texts]
    assert kind(path).encode_all(texts) == expected
    asked, found = [], kind(path)
    found._encode = lambda chunks, mark, known=found._encode: asked.extend(chunks) or known(chunks, mark)
    plain = [" ".join(w for w in t.split() if w.isalpha() and max(w) < "Ā" and not set(w) & set("ªµº")) for t in texts[:100]]
    assert found.encode_all([" " + p for p in plain]) and not [c for c in asked if c]


def test_byte_level_form_of_many_plain_chunks_at_once():
    letters = [c for c in map(chr, range(65, 256)) if c.isalpha() and c not in "ªµº"]
    words = [lead + x + y for lead in ("", " ") for x in letters for y in letters[::7]]
    found, library = ByteEncoder(BYTES), Tokenizer.from_file(BYTES)
    assert found._modelled(words) == [np.array(library.encode(w, add_special_tokens=False).ids, np.uint16).tobytes() for w in words]
    assert found._modelled([]) == []


def test_chunks_of_the_older_generation_are_known_again():
    found = ByteEncoder(BYTES)
    found.generation, asked = 10, []
    found._modelled = lambda words, known=found._modelled: asked.extend(words) or known(words)
    texts = ["alpha beta, gamma.", " ".join(f"word{c}" for c in "abcdefghijkl"), "none", "beta gamma, alpha"]
    expected = [Tokenizer.from_file(BYTES).encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(found.encode_all([t])[0], np.uint16).tolist() for t in texts] == expected
    assert len(asked) == len(set(asked))


def test_a_word_is_looked_up_once_whatever_signs_follow_it():
    found, asked = ByteEncoder(BYTES), []
    found._modelled = lambda words, known=found._modelled: asked.extend(words) or known(words)
    text = "Über! über, über\u00fc*** über's über.\nüber's (über) 12, 12%% ×, ÷. ª! Ωb, Ω! é×, a²."
    texts = ["", text, "", "two  blanks, über!", "a<|endoftext|>b, über***", "\u00a0über;", "", "über?", ""]
    library = Tokenizer.from_file(BYTES)
    expected = [np.array(library.encode(t, add_special_tokens=False).ids, np.uint16).tobytes() for t in texts]
    assert found.encode_all(texts) == expected
    assert sorted(w for w in asked if w.endswith("über")) == [" über", "über"]
    chunks, first = found.chunks(["", "Ab cd*** cd's\n'x (y)", "a  b, c!", ""])
    assert chunks.to_pylist() == ["Ab", " cd", "***", " cd", "'s", "\n", "'x", " (y", ")", "a  b,", " c!"]
    assert first.tolist() == [0, 0, 9, 11, 11]
    assert found.encode_all(["", ""]) == [b"", b""] and found.encode_all([]) == []


def test_cut_texts_have_the_library_ids():
    rng = random.Random(5)
    parts = ["a", "Zé", "ß", "ñ", "×", "÷", "ª", "²", "½", "7", "42", "Ω", "中", "\u0301", "\U0001f600", "'", "'s", "'ll", "\"", ".", ",", "<", "|", ">", "_", "$%"]
    parts += [" ", " ", " ", "\n", "word", "re", "-"]
    odd = ["  ", "\t", "\u00a0", "\u3000", "\u200b", "\x00", "\x7f", "\u2028", "\r\n", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts + odd * (k % 3 == 0), k=rng.randint(0, 30))) for k in range(6000)]
    texts += ["y" * 130 + ".", " " + "y" * 127 + "!", "x" * 500 + ", x"]
    for kind, path in ((ByteEncoder, BYTES), (WordEncoder, WORDS)):
        library, found = Tokenizer.from_file(path), kind(path)
        expected = [np.array(library.encode(t, add_special_tokens=False).ids, np.uint16).tobytes() for t in texts]
        assert found.encode_all(texts) == expected
        assert max(map(len, found.known)) <= 128


def test_workers_drop_what_other_kinds_of_task_kept(spark):
    """Tasks of one worker process: an encoder kept by one, then a task of another kind."""
    ship(spark)

    def fill(batches):
        for batch in batches:
            encoder(WordEncoder, WORDS)
            yield batch

    def look(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(common.KEPT["encoders"])] * batch.num_rows, pa.int64())], ["id"])

    rows = spark.range(64, numPartitions=8)
    for _ in range(2):
        assert rows.mapInArrow(releasing(fill, "encoders"), "id long").count() == 64
    assert max(r["id"] for r in rows.mapInArrow(releasing(look, "encoders"), "id long").collect()) > 0
    assert {r["id"] for r in rows.mapInArrow(releasing(look), "id long").collect()} == {0}
