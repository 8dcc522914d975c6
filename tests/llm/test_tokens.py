import public_tokenizers
import pytest
import sentencepiece as library

from tailframe.llm import sentencepiece as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", None, " ", "  a  b\n c", "<s> é\x00", "a" * 5000, "x y " * 2000, "日本語 😀👍🏽\ttab", "The quick brown fox's unbelievable (2024-01-01) https://example.com/?a=b", "a"]


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return sp.PieceModel.parse(f.read())


def test_ids_are_the_librarys(spark, sf_dir, model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame(list(enumerate(TEXTS, 10**9)), "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    lib = library.SentencePieceProcessor(model_file=PATH)
    for r in sp.encode_and_verify(docs, model).collect():
        assert r.ids == lib.encode(texts[r.doc_id] or ""), texts[r.doc_id]
        assert r.n_tokens == len(r.ids) and r.round_trip


def test_decode_is_the_librarys(spark, model):
    lib = library.SentencePieceProcessor(model_file=PATH)
    rows = [(lib.encode(t or ""),) for t in TEXTS] + [([259, 0, 3 + 0xE6, 400],), (None,)]
    got = sp.decode(spark.createDataFrame(rows, "ids array<int>"), model).collect()
    assert [r.decoded for r in got] == [lib.decode(i or []) for (i,) in rows]


def test_unigram_model_finds_the_best_segmentation():
    pieces = ["<unk>", "▁", "a", "b", "ab", "▁a", "ba", "bab"]
    model = sp.PieceModel(pieces, [0, -3.0, -2.0, -2.5, -3.2, -4.0, -3.0, -5.0], [2] + [1] * 7, False, True, False, True)

    def best(word):
        if not word:
            return 0.0, []
        options = []
        for n in range(1, len(word) + 1):
            p = word[-n:]
            score = model.scores[pieces.index(p)] if p in pieces else (min(model.scores) - 10 if n == 1 else None)
            if score is not None:
                s, before = best(word[:-n])
                options.append((s + score, [*before, pieces.index(p) if p in pieces else 0]))
        return max(options)

    words = sorted({"▁" + "".join(w) for n in range(6) for w in __import__("itertools").product("abc", repeat=n)})
    for word, ids in zip(words, model.encode_words(words)):
        score = sum(model.scores[i] if i else min(model.scores) - 10 for i in ids)
        assert score == pytest.approx(best(word)[0]), word


def test_empty_clashing_and_repeated(spark, model):
    docs = spark.createDataFrame([(1, "a b", [7]), (1, "a b", [7])], "doc_id long, text string, ids array<int>")
    assert len({tuple(r.ids) for r in sp.encode_and_verify(docs, model).collect()}) == 1
    assert sp.encode(docs, model).columns == ["doc_id", "text", "ids"]
    assert sp.encode_and_verify(docs.limit(0), model).count() == 0


def test_model_file_is_read_by_spark(spark, model):
    assert sp.load_model(spark.range(1), PATH).pieces == model.pieces


def test_words_are_cut_where_no_piece_crosses(model):
    """Punctuation behind a word no longer makes it another word; ids stay the library's."""
    model.prepare()
    lib = library.SentencePieceProcessor(model_file=PATH)
    text = "▁Word.***\nnext▁▁(a)▁x1y▁été!!▁日本"
    words = model.words.findall(text)
    assert "".join(words) == text and words[:3] == ["▁Word", ".***\n", "next"]
    for t in ["Word.***\nnext  (a) x1y été!! 日本", "a.b,c;d\n\ne", "don't [x-y]^z\\", "...", "###a", "Ünß$$$ und_so"]:
        starts, ids = sp._Encoder(model)([model.normalize(t)])
        assert ids.tolist() == lib.encode(t) and model.decode(ids.tolist()) == t
