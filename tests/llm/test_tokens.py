import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from documents_llm import no_documents, odd_documents  # noqa: F401

from tickloom.llm import packing, rans, tokens
from tickloom.llm.tokens import ByteEncoder, WordEncoder

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "\n", "a", " a", "a ", "a  b", "a   b", "a \n b", "a\n \n b\n", "\n\n a", "x\t y", "x \t y  ", "it's 'S, it's. ", "12 345, 6.0 100",
    "<|endoftext|> a<|endoftext|>", "\x1c a \x1d b", "Σ ΑΣ ΟΔΟΣ.", "é ́e,", "a\xa0 \xa0b", "   b", "a　 b", "a\t\t\n b", "“a” b", "0", "\0 \0", "é, ñ. x,.",
]


def encoded(encoder, texts, end):
    ids, begins = encoder.encode(pa.array(texts, pa.string()), [end])
    return [ids[begins[i] : begins[i + 1]].tolist() for i in range(len(texts))]


@pytest.mark.parametrize("kind, path", [(ByteEncoder, BYTES), (WordEncoder, WORDS)])
def test_units_give_the_ids_of_the_whole_text(kind, path):
    encoder, r = kind(path), random.Random(3)
    pieces = ["ab", "c,", "Dé.", " ", " ", "\n", "\t", "\xa0", "0", "'s", "x.", " ", "中", "\x1f"]
    texts = ODD + ["".join(r.choices(pieces, k=r.randint(1, 12))) for _ in range(2000)]
    want = [[*e.ids, 7] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoded(encoder, texts, 7) == want
    assert [encoded(encoder, [t], 7)[0] for t in texts[:200]] == want[:200]


@pytest.mark.parametrize("n", [1, 5, rans.LANES - 1, rans.LANES, rans.LANES * rans.STRIDE + 3])
def test_blocks_round_trip_and_part_by_part(n):
    ids = np.minimum(np.random.default_rng(n).pareto(1.0, n) * 20, 50_000).astype(np.int64)
    table = rans.Table(np.bincount(ids, minlength=65536))
    block = rans.encode_block(ids, table)
    assert (rans.decode_block(block, table) == ids).all()
    parts = -(-n // (rans.LANES * rans.STRIDE))
    assert (rans.decode_block(block, table, range(parts - 1, parts)) == ids[(parts - 1) * rans.LANES * rans.STRIDE :]).all()
    spoiled = bytearray(block)
    spoiled[len(block) // 2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans.decode_block(bytes(spoiled), table)


def whole_ids(path, text, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end])


def test_files_hold_the_documents_in_order(spark, odd_documents):
    folder = rans.token_files(odd_documents, BYTES)
    got = rans.read(spark, folder, with_ids=True).collect()
    got.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in odd_documents.select("doc_id").collect()), key=lambda d: (d is None, d or 0))
    at = 0
    for r in got:
        ids = np.frombuffer(r["ids"], "<u2")
        assert (r["start"], r["n_tokens"]) == (at, len(ids)) and r["ids_crc32"] == zlib.crc32(ids.astype("<u4").tobytes())
        at += len(ids)
    for wanted in odd_documents.select("doc_id", "text").collect():
        ids = whole_ids(BYTES, wanted["text"], 2)
        assert any(r["doc_id"] == wanted["doc_id"] and (np.frombuffer(r["ids"], "<u2").tolist() == ids.tolist()) for r in got)


def test_no_documents(spark, no_documents):
    assert rans.read(spark, rans.token_files(no_documents, BYTES)).count() == 0
    assert packing.pack_documents(no_documents, WORDS).count() == 0


def test_windows_are_full_and_lose_nothing(spark, odd_documents):
    pieces = packing.pack_documents(odd_documents, WORDS, with_ids=True).toPandas()
    assert len(pieces.drop_duplicates(["sequence_id", "offset"])) == len(pieces)
    sizes = pieces.groupby("sequence_id")["length"].sum()
    assert (sizes.iloc[:-1] == packing.WINDOW).all() and sizes.index.tolist() == list(range(len(sizes)))
    in_order = pieces.sort_values(["sequence_id", "offset"])
    assert (in_order["offset"] == in_order.groupby("sequence_id")["length"].cumsum() - in_order["length"]).all()
    total = sum(len(whole_ids(WORDS, r["text"], 1)) for r in odd_documents.select("text").collect())
    assert pieces["length"].sum() == total
    five = pieces[pieces["doc_id"] == 5].sort_values("start")
    text = odd_documents.filter("doc_id = 5").first()["text"]
    assert np.concatenate([np.frombuffer(b, "<u2") for b in five["ids"]]).tolist() == whole_ids(WORDS, text, 1).tolist()
    assert all(zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) == r.ids_crc32 for r in pieces.itertuples())


@pytest.mark.parametrize("weights", [None, [1.0, 5.0, 2.0]])
def test_rounds_place_every_token_once_and_keep_the_proportions(weights):
    totals = np.array([5000, 12345, 777])
    share = totals if weights is None else np.array(weights)
    schedule = packing.Rounds(totals, share, 256, 32)
    places, served = [], {}
    for queue, n in enumerate(totals):
        _, _, length, place = packing.pieces_of(schedule, np.array([queue]), np.array([0]), np.array([n]))
        tokens = np.concatenate([np.arange(p, p + m) for p, m in zip(place, length, strict=True)])
        assert (np.diff(tokens) > 0).all()
        places.append(tokens)
        served[queue] = tokens
    assert np.sort(np.concatenate(places)).tolist() == list(range(totals.sum()))
    # While all queues last, no queue is further from its share than a burst per queue and a round.
    for upto in range(256, 2048, 256):
        for queue in served:
            want = upto * share[queue] / share.sum()
            assert abs((served[queue] < upto).sum() - want) <= 3 * 32 + 32


PIECES = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", " ", "  ", "\n", "\n\n", "\t", "\u00a0", "\u2003", "\u3000", "\u0085", "’", "é", "e\u0301",
          "\u0301", "0", "10", "word", "Word,", "Été.", "don't", "x.", ",.", "...", "日本", "🙂", "<", "|", "a1b2", "naïve,", "\x1c", "ß."]


@pytest.mark.parametrize(("kind", "path"), [(tokens.ByteEncoder, BYTES), (tokens.WordEncoder, WORDS)])
def test_ids_are_those_of_the_untouched_library(kind, path):
    """Odd texts, with markers among them, and a store so small that its generations change all the time."""
    from tokenizers import Tokenizer

    dice, library, encoder = random.Random(17), Tokenizer.from_file(path), kind(path)
    encoder.most_units = 60
    for _ in range(40):
        texts = ["".join(dice.choices(PIECES, k=dice.choice([0, 1, 3, 8, 30]))) for _ in range(25)]
        texts += [" ".join(dice.choices(PIECES, k=12)) for _ in range(10)] + [f"x{dice.choice(PIECES)}", "plain words, only here."]
        ids, begins = encoder.encode(pa.array(texts), [2])
        for text, a, b in zip(texts, begins, begins[1:]):
            assert ids[a:b].tolist() == [*library.encode(text, add_special_tokens=False).ids, 2], repr(text)
    marked = library.encode("x<|endoftext|>", add_special_tokens=False).ids
    assert len(marked) == 2 and encoder.encode(pa.array(["x<|endoftext|>"]), [2])[0].tolist() == [*marked, 2]
