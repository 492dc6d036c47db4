"""Operator 9: the array form of the unit splitter gives what the patterns give."""
import random

import public_tokenizers
import pytest

from wattline.llm import piece_lattice
from wattline.llm.piece_lattice import all_units, load_model, unit_codes


@pytest.mark.parametrize("rows", [1, 7, 2_000])
def test_units_on_arrays_equal_the_patterns(rows):
    model, draw = load_model(public_tokenizers.path("piece_bpe_32k.model")), random.Random(3)
    alphabet = list("ab Z9.,\n\t\r  éÖ×÷ß¡ɏ▁'-日")
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.choice([0, 1, 2, 5, 30]))) for _ in range(1_500)]
    texts += ["", "\n\n", " ", " " * 80, "x" * 70 + " y", "a b " + "z" * 61, "£" * 61, "日" * 300]
    draw.shuffle(texts)
    for lo in range(0, len(texts), rows):
        part = texts[lo:lo + rows]
        expected = [model.units(t) for t in part]
        units, n = all_units(model, part)
        assert units.to_pylist() == [u for e in expected for u in e]
        assert n.tolist() == [len(e) for e in expected]
        different, place, _ = unit_codes(model, part)
        assert [different[p].as_py() for p in place[:200]] == units.to_pylist()[:200]


def test_plain_texts_are_not_cut_one_by_one(monkeypatch):
    model = load_model(public_tokenizers.path("piece_bpe_32k.model"))
    monkeypatch.setattr(piece_lattice.PieceModel, "units", lambda self, text: pytest.fail("a plain text was cut by the patterns"))
    assert all_units(model, ["plain words, 12 of them\n", ""])[0].to_pylist() == ["▁plain", "▁words", ",", "▁12", "▁of", "▁them", "\n"]
