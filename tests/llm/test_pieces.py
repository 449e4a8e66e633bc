import numpy as np
import pytest
import sentencepiece

from ledgerline.llm.pieces import MARK, MODEL, Encoder, PieceTable, _merge_rows, _unit_key, decode_pieces, encode_pieces, merge_with_agenda

TEXTS = ["", " ", "a", "hello world", "  two  spaces ", "line\nend\n\n", "tab\tand\r\n", f"a{MARK}b {MARK}", "日本語 テスト", "😀 \U0001f9d1‍🚀 x", "é ﬁ ½ ²x x²",
         "x" * 500, "ab" * 40 + " " + " " * 70 + "end", "don't 3.14 e-mail a_b", "\x00\x01 \x1f", "nul\u2028sep\x85"]


@pytest.fixture(scope="module")
def table():
    with open(MODEL, "rb") as f:
        return PieceTable(f.read())


def test_without_dropout_as_the_library(table, lorem):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [t for t in [*TEXTS, *(lorem(i, 50) for i in range(20))] if MARK not in t and t.strip(" ") == t and "\x00" not in t]
    got = Encoder(table, 0.0, 1, 4).encode(texts, ["k"] * len(texts))
    for t, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, np.int32).tolist() == sp.encode(t), t


def test_agenda_and_rounds_agree(table):
    enc = Encoder(table, 0.3, 9, 1)
    for unit in [" international", "unbelievable", " aaaaaaaa", "...", " 1234567890", " Donaudampfschiff"]:
        symbols, odd = enc._symbols(unit)
        assert not odd
        key = _unit_key(unit, 9, 0)
        rows, n = _merge_rows(np.array([symbols], np.int32), np.array([len(symbols)]), table, np.array([key], np.uint64), enc.limit)
        assert rows[0, : n[0]].tolist() == merge_with_agenda(symbols, table, key, enc.limit)


def test_round_trip_in_spark(spark, docs_of, lorem):
    from pyspark.sql import functions as F

    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (900, None), (901, lorem(1, 3000)), (902, lorem(1, 3000)), (901, lorem(1, 3000))]
    docs = docs_of(rows).withColumn("piece_ids", F.lit("clash")).withColumn("decoded", F.lit("kept"))
    out = encode_pieces(docs, dropout=0.2, seed=3)
    assert [f.name for f in out.schema] == ["doc_id", "text", "lang", "source", "n_chars", "decoded", "piece_ids"]
    got = decode_pieces(out).collect()
    assert len(got) == len(rows) and all(r["decoded"] == r["text"] for r in got)
    assert all(r["piece_ids"] is None for r in got if r["text"] is None)
    ids = {}
    for r in got:
        ids.setdefault(r["doc_id"], set()).add(tuple(r["piece_ids"] or ()))
    assert len(ids[901]) == 1  # a document is cut the same way each time
    again = encode_pieces(docs.repartition(3), dropout=0.2, seed=3).where("doc_id = 901").first()["piece_ids"]
    assert {tuple(again)} == ids[901]
    assert encode_pieces(docs.limit(0)).count() == 0


def test_dropout_varies_the_cuts(table, lorem):
    text = lorem(4, 200)
    enc = Encoder(table, 0.2, 3, 8)
    cuts = {enc.encode([text], [str(k)])[0] for k in range(40)}
    assert 2 <= len(cuts) <= 8
    plain = Encoder(table, 0.0, 3, 8).encode([text], ["1"])[0]
    assert all(len(c) > len(plain) for c in cuts)


def test_every_occurrence_is_cut_by_its_own_key(table, lorem):
    from ledgerline.llm.pieces import ARRAY_SYMBOLS, _units, place_keys

    texts = [*TEXTS, "international understanding " * 60, lorem(5, 300), "日本語 naïve 😀😀 unbelievable " * 20]
    for dropout in (0.1, 0.6, 1.0):
        enc = Encoder(table, dropout, 3)
        for _ in range(2):  # anew, and from the cuts kept
            for doc, (text, got) in enumerate(zip(texts, enc.encode(texts, list(map(str, range(len(texts))))), strict=True)):
                units = [u for part in _units(text, table.unit) for u in part]
                keys = place_keys(_unit_key(text, 3, enc.stream(str(doc))), np.arange(len(units)))
                assert got == b"".join(enc._long(u, int(k)) for u, k in zip(units, keys, strict=True)), text
    assert any(len(u) > ARRAY_SYMBOLS for t in texts for part in _units(t, table.unit) for u in part)


def test_cuts_are_not_limited_to_a_few_streams(spark, docs_of, lorem):
    from pyspark.sql import functions as F

    text = "international understanding " * 80
    got = encode_pieces(docs_of([(i, text) for i in range(40)]), dropout=0.2, seed=3)
    assert got.select(F.count_distinct("piece_ids")).first()[0] == 40
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = got.where("doc_id = 7").first()["piece_ids"]
    cuts = {p for p in "".join(sp.id_to_piece(i) + "|" for i in ids).split(MARK) if p.replace("|", "") == "international"}
    assert len(cuts) > 4  # within a document, too


def test_trimmed_cuts_give_the_same_pieces(monkeypatch):
    import pyarrow.parquet as pq

    from ledgerline.llm import pieces as P
    from tests.conftest import SF_SMALL

    table = P.PieceTable(open(P.MODEL, "rb").read())
    texts = pq.read_table(f"{SF_SMALL}/documents.parquet").column("text").to_pylist()[:60]
    keys = [str(i) for i in range(len(texts))]
    whole = P.Encoder(table, 0.3, 7).encode(texts, keys)
    monkeypatch.setattr(P, "CACHE_UNITS", 400)
    small, out = P.Encoder(table, 0.3, 7), []
    for t, k in zip(texts, keys):
        out += small.encode([t], [k])
    assert out == whole
    small.cuts.trim(300)
    cuts = small.cuts
    assert 0 < len(cuts.ids) <= 300 and all(cuts.unit[i] == u for u, i in cuts.plain.items())
    n = len(cuts.ids)
    assert all(cuts.unit[c] == cuts.unit[i] for i in range(n) for c in cuts.child[cuts.first[i] : cuts.first[i] + cuts.count[i]].tolist() if c >= 0)
    assert [x for t, k in zip(texts, keys) for x in small.encode([t], [k])] == whole
