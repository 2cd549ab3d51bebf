"""Licence scans: whole texts, look-alikes, and the alignment against a plain one."""

import random

import pytest

from sensorflow.llm.license_scan import WORD, LicenseIndex
from sensorflow.llm.license_texts import TEMPLATES

INDEX = LicenseIndex(TEMPLATES)
FILL = "The quick brown fox jumps over a lazy dog near some river bank. "


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_every_template_is_found_under_its_own_name(name):
    text = FILL + TEMPLATES[name] + " " + FILL
    found = INDEX.scan(text)
    assert [f[0] for f in found] == [name] and found[0][1] == 1.0
    words = [m.span() for m in WORD.finditer(TEMPLATES[name].lower())]
    assert found[0][4:] == (len(FILL) + words[0][0], len(FILL) + words[-1][1])


def test_numbered_and_reflowed_texts_keep_their_name():
    three = TEMPLATES["BSD-3-Clause whole text"]
    for k, part in enumerate(("Redistributions of source", "Redistributions in binary", "Neither the name"), 1):
        three = three.replace(part, f"\n   {k}. {part}")
    assert [f[0] for f in INDEX.scan(three.replace(" ", "\n * ", 20))] == ["BSD-3-Clause whole text"]
    mit = "MIT License\n\nCopyright (c) 2020 Somebody\n\n" + TEMPLATES["MIT whole text"]
    assert [(f[0], f[1], f[5]) for f in INDEX.scan(mit)] == [("MIT whole text", 1.0, len(mit) - 1)]


def test_look_alikes_are_told_apart():
    gpl = TEMPLATES["GPL header"]
    assert [f[0] for f in INDEX.scan(gpl.replace("GNU General", "GNU Affero General"))] == ["AGPL-3.0 header"]
    assert [f[0] for f in INDEX.scan(gpl.replace("GNU General", "GNU Lesser General"))] == ["LGPL-3.0 header"]
    assert [f[0] for f in INDEX.scan(gpl.replace("version 3", "version 2"))] == ["GPL-2.0 header"]
    assert [f[0] for f in INDEX.scan(TEMPLATES["LGPL-2.1 header"].replace("Lesser ", ""))][0] in ("GPL-2.0 header", "LGPL-2.1 header")


def test_parts_and_neighbours():
    half = TEMPLATES["MIT whole text"].split(" THE SOFTWARE IS")[0]
    assert [f[0] for f in INDEX.scan(half)] == ["MIT text"]
    both = TEMPLATES["ISC whole text"] + "\n" + TEMPLATES["GPL-3.0 notice"] + " " + TEMPLATES["ISC whole text"]
    assert [f[0] for f in INDEX.scan(both)] == ["ISC whole text", "GPL-3.0 notice", "ISC whole text"]
    assert INDEX.scan(FILL * 50) == [] and INDEX.scan("") == []


def plain_matched(template, ids, diagonal, band):
    """Longest common subsequence of cells at most ``band`` off the diagonal, cell by cell."""
    best = {}
    for i in range(len(template)):
        for j in range(i + diagonal - band, i + diagonal + band + 1):
            here = max(best.get((i - 1, j), 0), best.get((i, j - 1), 0))
            if 0 <= j < len(ids) and ids[j] == template[i]:
                here = max(here, best.get((i - 1, j - 1), 0) + 1)
            best[i, j] = here
    return max(best.values(), default=0)


def test_alignment_equals_a_plain_one():
    rng = random.Random(6)
    for _ in range(150):
        template = [rng.randrange(1, 6) for _ in range(rng.randrange(1, 14))]
        ids = [rng.randrange(0, 6) for _ in range(rng.randrange(0, 30))]
        index = LicenseIndex({"t": "a b c"}, band=rng.choice([1, 2, 4]))
        diagonal = rng.randrange(-4, 20)
        matched, first, last = index.align(template, ids, diagonal)
        assert matched == plain_matched(template, ids, diagonal, index.band)
        if matched:
            assert 0 <= first <= last < len(ids) and last - first + 1 >= matched
            assert ids[first] in template and ids[last] in template
