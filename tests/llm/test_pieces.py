"""SentencePiece segmentation against all segmentations of short texts."""

import copy
import gc
import random
import time
from array import array

import pytest
from pyspark.sql import functions as F

from orderlens.llm import pieces
from orderlens.llm.registry import PIECE_MODEL


@pytest.fixture(scope="module")
def model():
    with open(PIECE_MODEL, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def vocabulary(model):
    return pieces.Vocabulary(model)


def every(vocabulary, text):
    """All segmentations of a text with their scores."""
    marked = pieces.SPACE + text.replace(pieces.SPACE, pieces._HIDDEN).replace(" ", pieces.SPACE) if text else ""

    def rest(at):
        if at == len(marked):
            return [((), 0.0)]
        found = []
        if marked[at] not in vocabulary.ids:
            raw = tuple(vocabulary.bytes[b] for b in pieces._literal(marked[at]).encode())
            found += [(raw + ids, vocabulary.unknown + score) for ids, score in rest(at + 1)]
        for end in range(at + 1, len(marked) + 1):
            piece = vocabulary.ids.get(marked[at:end])
            if piece is not None:
                found += [((piece, *ids), vocabulary.scores[piece] + score) for ids, score in rest(end)]
        return found

    return dict(rest(0))


def test_n_best_are_the_best_of_all(vocabulary):
    encoder = pieces.Encoder(vocabulary, 4)
    random.seed(5)
    for _ in range(200):
        text = "".join(random.choice("theion a▁é, .\n") for _ in range(random.randint(0, 11)))
        raw, ranked = encoder.encode(text)
        ids = list(array("i", raw))
        truth = every(vocabulary, text)
        assert [score for score, _ in ranked] == sorted(truth.values(), reverse=True)[:4]
        chosen = [tuple(pieces.segmentation(ids, edits)) for _, edits in ranked]
        assert len(set(chosen)) == len(chosen)
        assert all(truth[one] == score for one, (score, _) in zip(chosen, ranked))
        assert all(pieces.decode(vocabulary, one) == text for one in chosen)


def test_ties_go_by_ids_from_the_end(vocabulary):
    for chunk in ("▁aaaa", "▁tion", "▁ttt"):
        ranked = pieces.n_best(vocabulary, chunk, 8)
        assert ranked == sorted(ranked, key=lambda r: (-r[0], r[1][::-1]))


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    texts = [" ".join("abcdefgh"[i % 8] * (i % 5 + 1) for i in range(60))] * 2
    kept = [pieces.Encoder(vocabulary, 3).encode(t) for t in texts]
    monkeypatch.setattr(pieces, "CACHE_CHUNKS", 2)
    encoder = pieces.Encoder(vocabulary, 3)
    assert [encoder.encode(t) for t in texts] == kept


def test_rows_of_any_kind(spark, model):
    texts = [None, "", " ", "a  b", "x\n\ty", "é中\U0001f600", "▁literal", "same", "same", "long " * 50_000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    rows = pieces.segment(docs, model, 3)
    got = {r.doc_id: r for r in rows.collect()}
    assert all(got[i].round_trip for i in range(len(texts)))
    assert got[0].ids == [] and got[0].n_best[0].score == 0.0 and len(got[1].n_best) == 1
    assert got[7].ids == got[8].ids and len(got[9].ids) >= 50_000
    back = {r.doc_id: r.text for r in pieces.decoded(rows.select("doc_id", "ids"), model).collect()}
    assert [back[i] for i in range(len(texts))] == ["", *texts[1:]]


def test_empty_table(spark, model):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.segment(docs, model).count() == 0


def test_null_ids_decode_to_null(spark, model):
    rows = spark.range(1).select(F.lit(None).cast("array<int>").alias("ids"))
    assert pieces.decoded(rows, model).first().text is None


def test_no_segmentation_is_refused(vocabulary):
    with pytest.raises(ValueError, match="at least one"):
        pieces.Encoder(vocabulary, 0)


def test_gap_is_that_of_the_search(vocabulary):
    random.seed(8)
    for _ in range(300):
        chunk = "▁" + "".join(random.choice("theionaé\ud800,中") for _ in range(random.randint(0, 12)))
        ranked = pieces.n_best(vocabulary, chunk, 2)
        ids, score, gap = pieces.best_and_gap(vocabulary, chunk)
        assert (score, ids) == ranked[0]
        assert gap == (score - ranked[1][0] if len(ranked) > 1 else float("inf"))


def test_code_points_without_a_character(vocabulary):
    for text in ("a\ufdd0b", "▁ \ufdd0 ▁▁", "\uffff \U0010ffff"):
        ids = list(array("i", pieces.Encoder(vocabulary, 4).encode(text)[0]))
        assert pieces.decode(vocabulary, ids) == text


def test_many_best(vocabulary):
    truth = every(vocabulary, "theion an")
    ranked = pieces.Encoder(vocabulary, 30).encode("theion an")[1]
    assert [score for score, _ in ranked] == sorted(truth.values(), reverse=True)[:30]


def test_a_long_word_takes_linear_time(vocabulary):
    def seconds(n):
        random.seed(n)
        text = "".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
        began = time.process_time()
        ids = array("i", pieces.Encoder(vocabulary, 4).encode(text)[0])
        assert pieces.decode(vocabulary, ids) == text
        return time.process_time() - began

    assert seconds(100_000) < 30 * seconds(10_000) + 1


def test_gap_takes_no_second_pass(vocabulary, monkeypatch):
    """The second best way is known at each node, so a chunk's arcs are neither kept nor walked again; ties of score stay ties."""
    vocabulary = copy.copy(vocabulary)
    number = vocabulary.ids["▁"]
    tree = {"x": [{"x": [{}, number + 2, -2.0]}, number + 1, -1.0]}
    monkeypatch.setattr(vocabulary, "tree", tree)
    monkeypatch.setattr(vocabulary, "ids", {"x": number + 1, "xx": number + 2})
    assert pieces.best_and_gap(vocabulary, "xx") == ((number + 1, number + 1), -2.0, 0.0)
    assert pieces.best_and_gap(vocabulary, "x") == ((number + 1,), -1.0, float("inf"))
    assert "arcs" not in pieces.best_and_gap.__code__.co_varnames


def test_no_search_for_cycles_while_texts_are_encoded(vocabulary):
    encoder, texts = pieces.Encoder(vocabulary, 4), ["some words", "", "öde ▁ x \U0001f600"]
    alone, seen = [encoder.encode(text) for text in texts], []
    encode = encoder.encode
    encoder.encode = lambda text: seen.append(gc.isenabled()) or encode(text)
    assert encoder.encode_all(texts) == alone
    assert seen == [False] * 3 and gc.isenabled()
