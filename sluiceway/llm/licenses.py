"""License scans by ordered signature rules.

A text is lower-cased (A-Z) and cut into words; its words, joined by blanks, are what the rules see.
Every rule is a regular expression over whole words with a keyword that it can't match without. One
Aho-Corasick pass finds the keywords that a text holds, and only their rules run. Overlapping
detections are resolved by priority and containment: a detection within the interval of one that
ranks before it is dropped. The few base phrases are reported always.

Rules come from two lists of fixed values that are ranked together. :func:`build_rules` takes a table
of license families through a table of wordings, which makes some hundreds. :func:`signatures` has
what follows no template: SPDX ids, also as parts of expressions, names fused with versions (GPLv2),
bare ids after "released under", addresses of licenses, and sentences of the licenses' own texts.

Defined results: a null text is empty; a text without words has no detections and score 0; repeated
rows are scanned alike; a map without shuffle, so any distribution of rows will do.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from sluiceway.llm.common import by_value, map_batches, whole_text

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Phrase and label.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Label, keyword, names (alternatives over words), versions.
FAMILIES = (
    ("gpl", "gnu", "gnu general public license|gnu gpl", ("1.0", "2.0", "3.0")),
    ("gpl", "gpl", "gpl", ("1.0", "2.0", "3.0")),
    ("lgpl", "gnu", "gnu lesser general public license|gnu library general public license|gnu lgpl", ("2.0", "2.1", "3.0")),
    ("lgpl", "lgpl", "lgpl", ("2.0", "2.1", "3.0")),
    ("agpl", "gnu", "gnu affero general public license|gnu agpl", ("1.0", "3.0")),
    ("agpl", "agpl", "agpl", ("1.0", "3.0")),
    ("gfdl", "gnu", "gnu free documentation license|gnu fdl", ("1.1", "1.2", "1.3")),
    ("apache", "apache", "apache software license|apache license|apache", ("1.0", "1.1", "2.0")),
    ("mit", "mit", "mit license|mit licence|mit x11 license", ()),
    ("bsd-2-clause", "bsd", "bsd 2 clause license|bsd 2 clause|simplified bsd license|2 clause bsd license", ()),
    ("bsd-3-clause", "bsd", "bsd 3 clause license|bsd 3 clause|new bsd license|revised bsd license|3 clause bsd license|modified bsd license", ()),
    ("bsd-4-clause", "bsd", "bsd 4 clause license|bsd 4 clause|original bsd license|4 clause bsd license", ()),
    ("bsd", "bsd", "bsd license|bsd licence|berkeley software distribution license", ()),
    ("isc", "isc", "isc license|isc licence", ()),
    ("mpl", "mozilla", "mozilla public license", ("1.0", "1.1", "2.0")),
    ("mpl", "mpl", "mpl", ("1.0", "1.1", "2.0")),
    ("epl", "eclipse", "eclipse public license", ("1.0", "2.0")),
    ("epl", "epl", "epl", ("1.0", "2.0")),
    ("cddl", "common", "common development and distribution license", ("1.0", "1.1")),
    ("cddl", "cddl", "cddl", ("1.0", "1.1")),
    ("cpl", "common", "common public license", ("1.0",)),
    ("eupl", "european", "european union public licence|european union public license", ("1.0", "1.1", "1.2")),
    ("eupl", "eupl", "eupl", ("1.0", "1.1", "1.2")),
    ("artistic", "artistic", "artistic license", ("1.0", "2.0")),
    ("osl", "open", "open software license", ("1.0", "2.0", "2.1", "3.0")),
    ("afl", "academic", "academic free license", ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("ofl", "sil", "sil open font license", ("1.0", "1.1")),
    ("ms-pl", "microsoft", "microsoft public license", ()),
    ("ms-rl", "microsoft", "microsoft reciprocal license", ()),
    ("bsl", "boost", "boost software license", ("1.0",)),
    ("busl", "business", "business source license", ("1.0", "1.1")),
    ("zlib", "zlib", "zlib license|zlib libpng license", ()),
    ("libpng", "libpng", "libpng license", ()),
    ("unlicense", "unlicense", "the unlicense|unlicense", ()),
    ("wtfpl", "wtfpl", "wtfpl", ("2.0",)),
    ("python", "python", "python software foundation license", ("2.0",)),
    ("php", "php", "php license", ("3.0", "3.01")),
    ("ruby", "ruby", "ruby license", ()),
    ("postgresql", "postgresql", "postgresql license", ()),
    ("odbl", "open", "open database license|odc open database license", ("1.0",)),
    ("pddl", "public", "public domain dedication and license", ("1.0",)),
    ("odc-by", "attribution", "open data commons attribution license", ("1.0",)),
    ("cc0", "cc0", "cc0", ("1.0",)),
    ("cc0", "creative", "creative commons zero", ("1.0",)),
    ("cc-by-nc-nd", "cc", "cc by nc nd", ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-sa", "cc", "cc by nc sa", ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc", "cc", "cc by nc", ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nd", "cc", "cc by nd", ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-sa", "cc", "cc by sa", ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by", "cc", "cc by", ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-nd", "creative", "creative commons attribution non ?commercial no ?deriv(?:ative)?s", ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-sa", "creative", "creative commons attribution non ?commercial share ?alike", ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc", "creative", "creative commons attribution non ?commercial", ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nd", "creative", "creative commons attribution no ?deriv(?:ative)?s", ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike", ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by", "creative", "creative commons attribution", ("2.0", "2.5", "3.0", "4.0")),
)

# Wordings: ending of the label, confidence, pattern; {name} and {version} are filled in. Earlier
# ones rank before later ones; those with a version apply to families that have some.
_LIC = "(?: international| generic| unported)?(?: public)?(?: licen[cs]e)?"
_VERSION = "(?: version| ver| v)? ?{version}"
_LATER = "(?: or (?:at your option )?(?:any )?(?:later|newer|greater)(?: version)?s?)"
_UNDER = "(?:licen[cs]ed|released|distributed|available|published|provided|redistributed|made available) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
WORDINGS = (
    ("-or-later", 1.0, "spdx licen[cs]e identifier {name}" + _VERSION + "(?: or later)"),
    ("", 1.0, "spdx licen[cs]e identifier {name}" + _VERSION + "(?: only)?"),
    ("", 1.0, "spdx licen[cs]e identifier {name}"),
    ("-or-later", 1.0, _UNDER + "{name}" + _VERSION + _LATER),
    ("", 0.95, _UNDER + "{name}" + _LIC + _VERSION + _LIC),
    ("-or-later", 0.9, "{name}" + _VERSION + _LATER),
    ("", 0.85, "{name}" + _LIC + _VERSION),
    ("", 0.8, _UNDER + "{name}" + _LIC),
    ("", 0.6, "{name}(?: licen[cs]e)"),
    ("", 0.5, "{name}"),
)


# Hand-written signatures. SPDX ids whose words are not a family's name: label, id as words. Whatever
# the families name ("gpl 2 0", "bsd 3 clause") their wordings find.
SPDX_IDS = (
    ("0bsd", "0bsd"),
    ("afl-1.1", "afl 1 1"), ("afl-1.2", "afl 1 2"), ("afl-2.0", "afl 2 0"), ("afl-2.1", "afl 2 1"), ("afl-3.0", "afl 3 0"),
    ("artistic-1.0", "artistic 1 0(?: perl| cl8)?"), ("artistic-2.0", "artistic 2 0"),
    ("beerware", "beerware"),
    ("blueoak-1.0.0", "blueoak 1 0 0"),
    ("bsd-1-clause", "bsd 1 clause"),
    ("bsl-1.0", "bsl 1 0"),
    ("busl-1.1", "busl 1 1"),
    ("bzip2-1.0.6", "bzip2 1 0 6"),
    ("cecill-2.1", "cecill 2 1"), ("cecill-b", "cecill b"), ("cecill-c", "cecill c"),
    ("cpl-1.0", "cpl 1 0"),
    ("curl", "curl"),
    ("ecl-2.0", "ecl 2 0"),
    ("elastic-2.0", "elastic 2 0"),
    ("fsfap", "fsfap"),
    ("gfdl-1.1", "gfdl 1 1(?: only)?"), ("gfdl-1.2", "gfdl 1 2(?: only)?"), ("gfdl-1.3", "gfdl 1 3(?: only)?"),
    ("gfdl-1.1-or-later", "gfdl 1 1 or later"), ("gfdl-1.2-or-later", "gfdl 1 2 or later"), ("gfdl-1.3-or-later", "gfdl 1 3 or later"),
    ("hpnd", "hpnd"),
    ("icu", "icu"),
    ("ipl-1.0", "ipl 1 0"),
    ("isc", "isc"),
    ("json", "json"),
    ("libpng", "libpng"), ("libpng-2.0", "libpng 2 0"),
    ("mit", "mit"), ("mit-0", "mit 0"),
    ("ms-pl", "ms pl"), ("ms-rl", "ms rl"),
    ("mulanpsl-2.0", "mulanpsl 2 0"),
    ("ncsa", "ncsa"),
    ("ntp", "ntp"),
    ("odbl-1.0", "odbl 1 0"),
    ("odc-by-1.0", "odc by 1 0"),
    ("ofl-1.0", "ofl 1 0(?: rfn| no rfn)?"), ("ofl-1.1", "ofl 1 1(?: rfn| no rfn)?"),
    ("openssl", "openssl"),
    ("osl-1.0", "osl 1 0"), ("osl-2.0", "osl 2 0"), ("osl-2.1", "osl 2 1"), ("osl-3.0", "osl 3 0"),
    ("pddl-1.0", "pddl 1 0"),
    ("php-3.0", "php 3 0"), ("php-3.01", "php 3 01"),
    ("postgresql", "postgresql"),
    ("python-2.0", "python 2 0(?: 1)?|psf 2 0"),
    ("ruby", "ruby"),
    ("sspl-1.0", "sspl 1 0"),
    ("tcl", "tcl"),
    ("unicode-3.0", "unicode 3 0"), ("unicode-dfs-2016", "unicode dfs 2016"),
    ("unlicense", "unlicense"),
    ("upl-1.0", "upl 1 0"),
    ("vim", "vim"),
    ("w3c", "w3c"),
    ("wtfpl", "wtfpl"),
    ("x11", "x11"),
    ("zlib", "zlib"),
    ("zpl-2.0", "zpl 2 0"), ("zpl-2.1", "zpl 2 1"),
)

# Label, name that is written together with the version, versions.
FUSED = (
    ("gpl", "gpl", ("1.0", "2.0", "3.0")),
    ("lgpl", "lgpl", ("2.0", "2.1", "3.0")),
    ("agpl", "agpl", ("1.0", "3.0")),
    ("gfdl", "gfdl", ("1.1", "1.2", "1.3")),
    ("mpl", "mpl", ("1.0", "1.1", "2.0")),
    ("epl", "epl", ("1.0", "2.0")),
    ("cddl", "cddl", ("1.0", "1.1")),
    ("eupl", "eupl", ("1.0", "1.1", "1.2")),
    ("osl", "osl", ("2.0", "2.1", "3.0")),
    ("apache", "apache", ("1.1", "2.0")),
)

# Ids that stand for a license by themselves after "released under" and the like.
BARE_IDS = (("mit", "mit"), ("mit-0", "mit 0"), ("isc", "isc"), ("zlib", "zlib"), ("bsd", "bsd"), ("0bsd", "0bsd"))

# Label, keywords, pattern: addresses of licenses, and sentences of licenses and their notices.
_PERSON = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
_FSF = " as published by the free software foundation "
TEXTS = (
    ("mit", "obtaining a copy of this software", f"{_PERSON} (?:the [^ ]+ )?to deal in the"),
    ("mit-0", "to do so the software is provided", f"{_PERSON} (?:[^ ]+ ){{10,60}}?to do so the software is provided"),
    ("ncsa", "deal with the software", "to deal with the software without restriction"),
    ("json", "for good not evil", "the software shall be used for good not evil"),
    ("isc", "with or without fee is hereby granted", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("0bsd", "with or without fee is hereby granted", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-2-clause", "with the distribution this software is provided by", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by"),
    ("bsd-3-clause", "to endorse or promote products", "neither the names? of (?:[^ ]+ ){1,16}?(?:may|can) be used to endorse or promote products derived from this software"),
    ("bsd-3-clause", "to endorse or promote products", "the names? of (?:the )?(?:author|authors|copyright holder|copyright holders|contributors) may not be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "all advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("zlib", "be held liable for any damages", "this software is provided as is without any express or implied warranty in no event will the authors? be held liable for any damages arising from the use of this software"),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("bsl-1.0", "person or organization obtaining a copy", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "you want to public license", "do what the [^ ]+ you want to public license"),
    ("postgresql", "without a written agreement is hereby granted", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("hpnd", "this software and its documentation for any purpose", "permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose (?:and without fee )?is hereby granted"),
    ("apache-2.0", "each contributor hereby grants to you", "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("apache-1.1", "developed by the apache software foundation", "this product includes software developed by the apache software foundation"),
    ("openssl", "developed by the openssl project", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("php", "this product includes php", "redistributions of any form whatsoever must retain the following acknowledge?ment this product includes php"),
    ("python-2.0", "between the python software foundation", "this license agreement is between the python software foundation"),
    ("artistic-1.0", "some semblance of artistic control", "the copyright holder maintains some semblance of artistic control"),
    ("artistic-2.0", "this license establishes the terms", "this license establishes the terms under which a given free software package may be copied"),
    ("ofl-1.1", "collaborative font projects", "the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects"),
    ("cc0-1.0", "with this deed has dedicated the work", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("beerware", "buy me a beer", "if we meet some day and you think this stuff is worth it you can buy me a beer"),
    *(
        (f"{label}-{v}{ending}", f"gnu {name} public license{_FSF}".strip(), f"gnu {name} public license{_FSF}(?:either )?version {words}(?: of the licen[cs]e)?{more}")
        for label, name, versions in (
            ("gpl", "general", (("1.0", "1"), ("2.0", "2(?: 0)?"), ("3.0", "3(?: 0)?"))),
            ("lgpl", "lesser general", (("2.1", "2 1"), ("3.0", "3(?: 0)?"))),
            ("lgpl", "library general", (("2.0", "2(?: 0)?"),)),
            ("agpl", "affero general", (("3.0", "3(?: 0)?"),)),
        )
        for v, words in versions
        for ending, more in (("-or-later", " or at your option any later version"), ("", ""))
    ),
    *(
        (f"cc-{kind.replace(' ', '-')}-{v}", "creativecommons org licenses", f"creativecommons org licenses {kind} {v.replace('.', ' ')}")
        for kind in ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd")
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0")
    ),
    ("cc0-1.0", "creativecommons org publicdomain", "creativecommons org publicdomain zero 1 0"),
    ("mit", "opensource org licenses mit", "opensource org licenses mit(?: license php)?"),
    ("isc", "opensource org licenses isc", "opensource org licenses isc(?: license)?"),
    ("zlib", "opensource org licenses zlib", "opensource org licenses zlib(?: license(?: php)?)?"),
    ("apache-2.0", "apache org licenses", "apache org licenses license 2 0"),
    ("bsl-1.0", "boost org license 1 0", "boost org license 1 0(?: txt)?"),
    *((f"{n}-{v}", f"gnu org licenses {n}", f"gnu org licenses {n} {v.replace('.', ' ')}") for n, vs in (("gpl", ("2.0", "3.0")), ("lgpl", ("2.1", "3.0")), ("agpl", ("3.0",))) for v in vs),
)


@dataclass(frozen=True)
class Rule:
    """``pattern`` over words between blanks, or its group if it has one; a smaller ``rank`` goes before."""

    rank: int
    label: str
    keyword: str
    confidence: float
    pattern: str


def _words_of(version: str) -> str:
    """2.0 as words: "2 0", the zero may be missing."""
    whole, _, part = version.partition(".")
    return f"{whole}(?: {part})?" if part == "0" else f"{whole} {part}"


def build_rules(families=FAMILIES, wordings=WORDINGS) -> list[Rule]:
    """Every family through every wording, in the order of wordings."""
    made = []
    for rank, (ending, confidence, pattern) in enumerate(wordings):
        for label, keyword, names, versions in families:
            filled = pattern.replace("{name}", f"(?:{names})")
            if "{version}" in pattern:
                for v in versions:
                    words = filled.replace("{version}", f"(?:{_words_of(v)})")
                    made.append(Rule(rank, f"{label}-{v}{ending}", keyword, confidence, words))
            elif not (rank == len(wordings) - 1 and len(names) < 6):  # short names alone prove nothing
                made.append(Rule(rank, label, keyword, confidence, filled))
    return made


def signatures() -> list[Rule]:
    """The hand-written rules, in the ranks of ``WORDINGS``."""
    tag, made = "spdx licen[cs]e identifier ", []
    # The words that expressions of SPDX ids are made of.
    own = {w for _, spelled in SPDX_IDS for w in re.findall("[a-z0-9]+", spelled)} | {k for _, k, _, _ in FAMILIES}
    own |= set("bsd clause by sa nc nd only later or and with exception classpath gcc runtime llvm linking clear".split())
    word = f"(?:{'|'.join(sorted(own))}|[0-9]+)"
    for label, spelled in SPDX_IDS:
        made.append(Rule(1, label, "spdx", 1.0, f"{tag}(?:{spelled})"))
        made.append(Rule(1, label, "spdx", 1.0, f"{tag}(?:{word} ){{1,24}}?(?:or|and) ({spelled})"))
    for label, name, versions in FUSED:
        for v in versions:
            whole, _, part = v.partition(".")
            for keyword in (f"{name}v{whole}", f"{name}{whole}"):
                spelled = f"{keyword}(?: 0)?" if part == "0" else f"{keyword} {part}"
                made.append(Rule(3, f"{label}-{v}-or-later", keyword, 1.0, _UNDER + spelled + _LIC + _LATER))
                made.append(Rule(4, f"{label}-{v}", keyword, 0.95, _UNDER + spelled + _LIC))
                made.append(Rule(5, f"{label}-{v}-or-later", keyword, 0.9, spelled + _LIC + _LATER))
                made.append(Rule(6, f"{label}-{v}", keyword, 0.85, spelled + _LIC))
    for label, spelled in BARE_IDS:
        for keyword in (f"under {spelled}", f"under the {spelled}", f"of {spelled}", f"of the {spelled}"):
            made.append(Rule(7, label, keyword, 0.7, _UNDER + spelled))
    return made + [Rule(0, label, keyword, 0.9, pattern) for label, keyword, pattern in TEXTS]


def all_rules() -> list[Rule]:
    """What a scan looks for unless it is given rules."""
    return build_rules() + signatures()


@dataclass(frozen=True)
class Detection:
    """Words ``start`` to ``end`` (exclusive)."""

    start: int
    end: int
    rule: Rule


class Scanner:
    """Compiled rules behind their keyword filter."""

    def __init__(self, rules: list[Rule]):
        self.keywords = ahocorasick.Automaton()
        by_keyword: dict[str, list[tuple[Rule, re.Pattern]]] = {}
        for r in rules:
            # A match starts after a blank and ends before one, so it covers whole words.
            compiled = re.compile(rf"(?<= ){r.pattern}(?= )".encode())
            by_keyword.setdefault(r.keyword, []).append((r, compiled))
        for keyword, own in by_keyword.items():
            self.keywords.add_word(f" {keyword} ", own)
        self.keywords.make_automaton()

    def detections(self, words: bytes) -> list[Detection]:
        """Detections that no earlier-ranking one contains, by start; ``words`` as of normalised()."""
        held = {id(own): own for _, own in self.keywords.iter(words.decode("latin-1"))}
        found = [
            (*m.span(pattern.groups), rule)
            for own in held.values()
            for rule, pattern in own
            for m in pattern.finditer(words)
        ]
        return _in_words(words, _uncontained(found))


def _uncontained(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Without those inside the interval of one of smaller rank, or of a wider or equal earlier one
    of the same rank."""
    kept, reach = [], {}
    for start, end, rule in sorted(found, key=lambda f: (f[0], -f[1], f[2].rank, f[2].label)):
        # Whatever was seen starts no later; it contains this one if it ends no earlier. Intervals
        # of one start come widest first, so a narrower one of smaller rank never needs to wait.
        if not any(to >= end for rank, to in reach.items() if rank <= rule.rank):
            kept.append((start, end, rule))
        reach[rule.rank] = max(reach.get(rule.rank, 0), end)
    # One of equal interval and smaller rank comes first by the order; done.
    return kept


def _in_words(words: bytes, found: list[tuple[int, int, Rule]]) -> list[Detection]:
    """Byte places as numbers of words, counted on from one to the next."""
    made, place, number = [], 0, -1
    for start, end, rule in found:
        number += words.count(b" ", place, start)
        place = start
        made.append(Detection(number, number + words.count(b" ", start, end) + 1, rule))
    return made


def normalised(text: bytes) -> tuple[bytes, int]:
    """The words of a UTF-8 text, lower-cased (A-Z), each between single blanks; their number."""
    words = WORD.findall(text.lower())
    return b" " + b" ".join(words) + b" ", len(words)


def base_places(words: bytes) -> dict[str, list[int]]:
    """Where each base phrase stands, as numbers of words."""
    made = {}
    for phrase, label in BASE:
        needle, at, number, place, starts = f" {phrase} ".encode(), -1, 0, 0, []
        while (at := words.find(needle, at + 1)) >= 0:
            number += words.count(b" ", place, at)
            place = at
            starts.append(number)
        made[label] = starts
    return made


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "detections array<struct<label: string, start: long, end: long, confidence: double>>"
)


def scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Per document: doc_id, counts and places of base phrases, labels, score and detections."""
    rules = rules or all_rules()
    kind = docs.schema["doc_id"].dataType.simpleString()
    found_type = pa.list_(
        pa.struct(
            [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("confidence", pa.float64())]
        )
    )
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), found_type]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
    scanners: list[Scanner] = []

    def scan_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not scanners:
            scanners.append(Scanner(rules))
        rows = []
        for text in batch.column(1).to_pylist():
            words, n = normalised(text)
            base, found = base_places(words), scanners[0].detections(words)
            starts = [s for own in base.values() for s in own]
            base_labels = {label for label, own in base.items() if own}
            labels = base_labels | {d.rule.label for d in found}
            sure = [d.rule.confidence for d in found] + [0.6] * bool(starts)
            rows.append(
                (
                    n,
                    len(starts),
                    min(starts, default=None),
                    max(starts, default=None),
                    ",".join(sorted(base_labels)),
                    ",".join(sorted(labels)),
                    max(sure, default=0.0),
                    [
                        {"label": d.rule.label, "start": d.start, "end": d.end, "confidence": d.rule.confidence}
                        for d in found
                    ],
                )
            )
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    texts = docs.select("doc_id", whole_text().cast("binary").alias("text"))
    return map_batches(texts, scan_batch, f"doc_id {kind}, {SCHEMA}")


by_value(__name__)
