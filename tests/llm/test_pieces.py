import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from llm.edges import documents, edge_texts, prose
from urbanlake.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=PATH)
ENCODER = pieces.PieceEncoder(pieces.model_bytes(PATH))

TEXTS = edge_texts() + [
    "a" * 5000, "é" * 3000, "12345" * 900, "!?" * 1500, "a  b\n\n c\t d   ", "▁a▁▁b▁", "日本語のテキスト" * 300, "é combining" * 40, "<s>x</s><unk><0x41>", "\x00\x01 \x7f",
    " " * 900, " ", "   lead and trail   ", "👩‍👩‍👧 family", "x²." * 40, prose(3, 9000), "�", "Ａ ｂ",
]


def own(text):
    raw = ENCODER.encode([text])[0]
    return [int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)]


def test_equals_the_library(spark):
    encoded = pieces.encode(documents(spark, TEXTS), pieces.model_bytes(PATH), carry=("doc_id", "row"), round_trip=True)
    got = encoded.collect()
    assert len(got) == len(TEXTS)
    for r in got:
        ids = LIBRARY.encode(TEXTS[r.doc_id - 1] or "")
        assert r.ids == ids, r.doc_id
        assert r.decoded == LIBRARY.decode(ids)


def test_decode_of_any_ids_and_nulls(spark):
    lists = [[], [0], [1, 2], [2, 11844], [84, 7, 221, 1, 178, 293], [259, 259], [3 + 0xE2, 3 + 0x96], [0, 400, 0], [31999], [1, 400, 3 + 0xF0, 500]]
    table = spark.createDataFrame([(i, x) for i, x in enumerate([*lists, None])], "k int, `my.ids` array<int>")
    got = {r.k: r.decoded for r in pieces.decode(table, pieces.model_bytes(PATH), "my.ids").collect()}
    assert got == {**{i: LIBRARY.decode(x) for i, x in enumerate(lists)}, len(lists): None}


def test_empty_table(spark):
    assert pieces.encode(documents(spark, []), pieces.model_bytes(PATH)).count() == 0


def test_cuts_are_taken_from_the_vocabulary():
    assert ENCODER.segmented
    assert not any("\n" in p for p in ENCODER.pairs)
    assert "".join(pieces.SEGMENT.findall("  a²é. b1_x ")) == "  a²é. b1_x "


def test_without_segments_the_whole_text_is_merged():
    whole = pieces.PieceEncoder(pieces.model_bytes(PATH))
    whole.segmented = False
    texts = [t or "" for t in TEXTS if len(t or "") < 4000]
    raw = whole.encode(texts)
    assert [[int.from_bytes(x[i : i + 4], "little") for i in range(0, len(x), 4)] for x in raw] == LIBRARY.encode(texts)


def test_a_difference_raises():
    broken = pieces.PieceEncoder(pieces.model_bytes(PATH))
    broken.order = {p: s for p, s in broken.order.items() if "th" not in p}
    with pytest.raises(ValueError, match="library"):
        broken.encode(["that the other"])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abeinorsth .,\n1"), st.characters(blacklist_categories=("Cs",))), max_size=60))
def test_any_text(text):
    ids = LIBRARY.encode(text)
    assert own(text) == ids
    assert ENCODER.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31999)), max_size=12))
def test_any_ids(ids):
    assert ENCODER.decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize("agenda", [pieces.short_agenda, pieces.long_agenda])
def test_agenda_takes_the_best_score_and_then_the_leftmost(agenda):
    order = {"ab": 1.0, "bc": 1.0, "cd": 0.0, "abcd": 9.0}
    assert agenda(list("abcd"), order) == ["abcd"]
    assert agenda(list("abc"), order) == ["ab", "c"]
    assert agenda(list("aaa"), {"aa": 0.0}) == ["aa", "a"]
    assert agenda([], order) == [] and agenda(["a"], order) == ["a"]


def test_forgotten_segments_are_learned_again():
    small = pieces.PieceEncoder(pieces.model_bytes(PATH), limit=5)
    for text in [prose(k, 30) for k in range(6)] * 2:
        assert [int.from_bytes(small.encode([text])[0][i : i + 4], "little") for i in range(0, 4 * len(LIBRARY.encode(text)), 4)] == LIBRARY.encode(text)
        assert len(small.known) + len(small.older) < 80


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abinorsth ", min_size=2, max_size=40))
def test_both_agendas_agree(text):
    assert pieces.short_agenda(list(text), ENCODER.order) == pieces.long_agenda(list(text), ENCODER.order)
