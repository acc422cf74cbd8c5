"""License templates: banded rows of numbers against single cells, every template with a changed word."""

from __future__ import annotations

import random
import time

import pytest

from starloom.llm import license_scan


def cell_by_cell(template, text, low, high):
    """The best local alignment, one tuple (score, matched, -start) per cell."""
    best, best_stop, row = (0, 0, 0), 0, {}
    for i, word in enumerate(template):
        new = {}
        for lane in range(high - low + 1):
            j = i + low + lane
            score, matched, start = row.get(lane, (0, 0, 0))
            if not score:
                start = -j
            equal = 0 <= j < len(text) and text[j] == word
            choices = [(score + 2, matched + 1, start) if equal else (score - 1, matched, start)]
            for near in (row.get(lane + 1), new.get(lane - 1)):
                if near:
                    choices.append((near[0] - 1, near[1], near[2]))
            cell = max(choices)
            if cell[0] > 0:
                new[lane] = cell
                if cell > best:
                    best, best_stop = cell, j + 1
        row = new
    return best[1], -best[2], best_stop


def test_band_rows_equal_single_cells():
    draw = random.Random(5)
    for _ in range(400):
        template = [draw.randrange(4) for _ in range(draw.randrange(1, 14))]
        text = [draw.randrange(-1, 4) for _ in range(draw.randrange(0, 25))]
        low = draw.randrange(-15, 20)
        high = low + draw.randrange(0, 20)
        assert license_scan.align(template, text, low, high) == cell_by_cell(template, text, low, high)


@pytest.mark.parametrize("name", sorted(license_scan.TEMPLATES))
def test_every_template_is_found_with_a_changed_word(name):
    words = license_scan.TEMPLATES[name].split()
    middle = len(words) // 2
    changed = " ".join([*words[:middle], "changed", *words[middle + 1 :]])
    index = license_scan.Index(license_scan.TEMPLATES)
    for text, least in ((license_scan.TEMPLATES[name], 1.0), (changed, 0.8)):
        before = "Some words of a document. "
        rows = [r for r in index.find(f"{before}{text} and more of them") if r[0] == name]
        if least == 1.0 or len(words) >= 8:
            assert len(rows) == 1 and rows[0][4] >= least and rows[0][1] >= len(before) - 1


def test_long_templates_take_well_below_a_second():
    draw = random.Random(6)
    text = " ".join(f"w{draw.randrange(900)}" for _ in range(5600))
    index = license_scan.Index({"long": text})
    began = time.monotonic()
    rows = index.find(f"before {text.replace(' w7 ', ' other ')} after")
    assert len(rows) == 1 and rows[0][4] > 0.98
    assert time.monotonic() - began < 5  # a loop over cells takes half a minute


def test_templates_from_a_table(spark, docs_of):
    own = "Anyone may read this text aloud on a Sunday and on no other day of the week."
    table = spark.createDataFrame([("own", own), ("none", None), (None, "x"), ("empty", "")], "license string, text string")
    docs = docs_of([(1, f"a {own} b"), (2, "Released under the MIT License."), (3, None)])
    assert [(r.doc_id, r.license, r.coverage) for r in license_scan.find_licenses(docs, table).collect()] == [(1, "own", 1.0)]
    assert license_scan.find_licenses(docs, table.limit(0)).collect() == []
    with pytest.raises(ValueError, match="twice"):
        license_scan.find_licenses(docs, table.union(table))
