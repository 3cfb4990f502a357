"""License rules: signatures, precedence, lists, negation, and words that look like names."""

import re

import brute
import pytest

from courtside.llm import license_scan

SCANNER = license_scan.Scanner()


def scanned(text):
    *_, labels, score = SCANNER.scan(text)
    assert (",".join(labels), score) == brute.licenses(text)
    return labels, score


@pytest.mark.parametrize("text, labels", [
    ("GNU Lesser General Public License v2.1", ["lgpl-2.1"]),
    ("Mozilla Public License, v. 2.0", ["mpl-2.0"]),
    ("This file is under the GNU General Public License.", ["gpl"]),
    ("released under the GNU General Public License version 3", ["gpl-3.0"]),
    ("Apache License, Version 2.0 and MIT", ["apache-2", "mit"]),
    ("licensed under the MIT or the Apache 2.0 license", ["apache-2", "mit"]),
    ("MIT or Apache 2.0", ["apache-2", "mit"]),
    ("BSD 3-clause and ISC and zlib license", ["bsd-3-clause", "isc", "zlib"]),
    ("GPL license mit Ausnahme", ["gpl"]),
    ("eine License mit der wir leben", []),
    ("license: MIT", ["mit"]), ("License MIT", ["mit"]), ("'license': 'mit',", ["mit"]), ("license mit\n", ["mit"]),
    ("not licensed under the GPL", []), ("This is no longer distributed under the MPL 2.0", []), ("never released under the Apache 2.0 license", []),
    ("not only licensed under the GPL", ["gpl"]),
    ("written in ruby and php under GPL v2 or later", ["gpl-2.0"]),
    ("under the MIT license", ["mit"]), ("not under the MIT license", ["mit"]),
    ("", []), ("no word of it", []),
])
def test_labels(text, labels):
    assert scanned(text)[0] == labels


def _example(pattern):
    """A text that a signature matches: its first alternatives, optional parts left out."""
    text = re.sub(r"\.\{(\d+),\d+\}", lambda m: "x" * max(1, int(m[1])), pattern.split("|")[0] if "(" not in pattern.split("|")[0] else pattern)
    while re.search(r"\((\?:)?[^()]*\)", text):
        text = re.sub(r"\((?:\?:)?([^()]*)\)(\??)", lambda m: "" if m[2] else m[1].split("|")[0], text)
    text = re.sub(r"\[([^\]])[^\]]*\]", r"\1", text)
    return re.sub(r" +", " ", re.sub(r"[a-z0-9 ]\?", lambda m: "" if m[0][0] == " " or True else m[0], text)).strip()


def test_every_signature_is_found():
    """Each hand-written signature passes its own gate and keywords."""
    assert len(license_scan.SIGNATURES) > 150
    assert len({p for p, *_ in license_scan.SIGNATURES}) == len(license_scan.SIGNATURES)
    for pattern, label, priority, confidence, keywords in license_scan.SIGNATURES:
        text = _example(pattern)
        assert re.fullmatch(pattern, text), (pattern, text)
        line = f" {text} "
        assert any(f" {k}" in line for k in keywords), (pattern, text)
        assert any(r.label == label for r in SCANNER.candidates(line.encode()))
        labels, score = scanned(text)
        found = [d.rule.label for d in license_scan.resolve(SCANNER.detections(line.encode(), text, SCANNER.rules))]
        assert label in found or score >= confidence, (pattern, found)
