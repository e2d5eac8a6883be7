"""Access, counts and places against plain arrays; documents against the tokenizer library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cohortloom.llm import registry, wavelet
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n, top", [(0, 4), (1, 1), (511, 7), (512, 300), (1300, 60_000)])
def test_matrix_against_array(n, top):
    ids = np.random.default_rng(n).integers(0, top + 1, n).astype(np.uint32) // 3
    made = wavelet.WaveletMatrix.build(ids, 16)
    again = wavelet.WaveletMatrix.load(n, 16, made.planes.tobytes(), made.ranks.tobytes())
    assert (again.decode() == ids).all()
    for at in range(0, n, 37):
        assert again.access(at) == ids[at]
        value = int(ids[at])
        assert again.count(value) == (ids == value).sum()
        assert again.count(value, at // 2, at) == (ids[at // 2 : at] == value).sum()
        places = np.flatnonzero(ids == value)
        assert [again.locate(value, k) for k in range(min(3, len(places)))] == places[:3].tolist()
    assert again.count(65_535) == 0 and again.count(1 << 20) == 0
    with pytest.raises(IndexError):
        again.access(n)


def test_checksums_join():
    a, b = b"some bytes" * 9, b"others" * 30_000
    assert wavelet.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


TEXTS = [
    None, "", "   \n", "It's WE'LL ''s don't", "ÀÉÎ ß naïve ²³ ª", "İSTANBUL Σίσυφος ΑΣ", "漢字 kana カナ 🙂", "é Å",
    "a\x85b\xa0c\x1cd\x7f", "<|endoftext|> <|startoftext|>", "word " * 9_000, "x" * 5_000, "1234 5.6e7", "a b­c",
    "ﬁ ligature", "a\tb\rc\x0bd\x0ce",
]


def wanted(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, registry.END_ID]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("room, shard", [(1 << 19, 24 << 20), (700, 4_000)])
def test_documents_come_back(spark, tmp_path, monkeypatch, room, shard):
    monkeypatch.setattr(wavelet, "MATRIX_IDS", room)
    monkeypatch.setattr(wavelet, "SHARD_BYTES", shard)
    rows = [(100 - i, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, shard int").repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.op8_wavelet_matrix(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == sorted(wanted(sorted(rows)))


def test_texts_are_cut_all_at_once(monkeypatch):
    with open(PATH, encoding="utf-8") as file:
        codec = wavelet.WordCodec(file.read())
    library, draw = Tokenizer.from_file(PATH), random.Random(5)
    parts = [*"''strevmld", "re", "ve", "ll", *" \n\t\r", "12", ".", "!", *"ßÉ÷×µªºÿ¡aB", "中", "\x85", "<|endoftext|>"]
    texts = ["".join(draw.choices(parts[: draw.choice([11, 17, 30, len(parts)])], k=draw.randint(0, 40))) for _ in range(3_000)]
    plain = [t for t in texts if codec._plain(t) is not None]
    words = library.pre_tokenizer.pre_tokenize_str
    # Cuts lie where the file's own splitter cuts, and only words go to the library, one time each.
    for t in plain[:300]:
        data = codec._plain(t)
        edges = codec._edges(data).tolist() if data else [0]
        cells = [data[a:b].decode("latin-1") for a, b in zip(edges, edges[1:])]
        cut = [c for c in cells if c.strip()]
        assert cut == [data.decode("latin-1")[a:b] for _, (a, b) in words(data.decode("latin-1"))]
    wanted_ids = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    for most in (50, wavelet.WordCodec.MOST_WORDS):
        monkeypatch.setattr(codec, "MOST_WORDS", most)
        got = [ids.tolist() for i in range(0, len(texts), 100) for ids in codec.encode(texts[i : i + 100])]
        assert got == wanted_ids
    asked = []
    monkeypatch.setattr(codec, "_learned", lambda words: asked.append(words))
    codec.encode(texts[-100:])
    assert asked == []


def test_added_tokens_as_the_library_reads_them(spark, tmp_path):
    texts = [
        "see <|endoftext|> here", "<|startoftext|><|endoftext|>", "a <|ENDOFTEXT|> b", "<|endoftext", "é<|endoftext|>漢",
        "see < |endoftext| > here", "after",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer, rows, start = Tokenizer.from_file(PATH), [], 0
    for doc, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, registry.END_ID]
        rows.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert rows[0][2] == 4
    got = registry.op8_wavelet_matrix(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == rows


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = registry.op8_wavelet_matrix(spark, sf_dir).collect()
    assert sorted(tuple(r) for r in got) == wanted(sorted(rows))


def test_null_and_repeated_keys_and_empty_table(spark):
    with open(PATH, encoding="utf-8") as file:
        definition = file.read()
    df = spark.createDataFrame([(1, "b"), (None, "a"), (1, "b"), (1, None)], "doc_id long, text string")
    rows = sorted(wavelet.round_trip(df, definition, 2).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 1, 1] and [r.start for r in rows][0] == 0
    assert sum(r.n_tokens for r in rows) == 7
    assert wavelet.round_trip(df.where("doc_id > 5"), definition, 2).collect() == []
