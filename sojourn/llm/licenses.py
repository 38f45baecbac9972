"""License scans by ordered signature rules behind a keyword prefilter."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, slices

#: Base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Licenses: label | keyword | name | identifier | address. All match texts in lower case whose words
#: are joined by single spaces, so "GPL-3.0" is "gpl 3 0". Each name gives a notice rule and a title
#: rule, each identifier a tag rule, each address an address rule; "-" gives none.
_LICENSES = r"""
mit | mit | mit(?: x11)? | mit | opensource org licenses? mit
mit | expat | expat(?: x11)? | - | -
apache-2 | apache | apache(?: software)?(?: public)?(?: license)?(?: v| version)? ?2(?: 0)? | apache 2 0 | apache org licenses license 2 0
apache-1.1 | apache | apache(?: software)?(?: license)?(?: v| version)? ?1 1 | apache 1 1 | apache org licenses license 1 1
gpl-2 | gpl | gpl(?: v| version)? ?2(?: 0)? | gpl 2 0(?: only| or later)? | gnu org licenses (?:old licenses )?gpl 2 0
gpl-2 | gnu general | gnu general public license(?: gpl)?(?: v| version) ?2(?: 0)? | - | -
gpl-3 | gpl | gpl(?: v| version)? ?3(?: 0)? | gpl 3 0(?: only| or later)? | gnu org licenses gpl(?: 3 0)?
gpl-3 | gnu general | gnu general public license(?: gpl)?(?: v| version) ?3(?: 0)? | - | -
gpl | gnu general | gnu general public license | - | -
lgpl-2.1 | lgpl | lgpl(?: v| version)? ?2(?: 1| 0)? | lgpl 2 [01](?: only| or later)? | gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-2.1 | gnu l | gnu (?:lesser|library) general public license(?: lgpl)?(?: v| version) ?2(?: 1| 0)? | - | -
lgpl-3 | lgpl | lgpl(?: v| version)? ?3(?: 0)? | lgpl 3 0(?: only| or later)? | gnu org licenses lgpl(?: 3 0)?
lgpl-3 | gnu l | gnu lesser general public license(?: lgpl)?(?: v| version) ?3(?: 0)? | - | -
lgpl | gnu l | gnu (?:lesser|library) general public license | - | -
agpl-3 | agpl | agpl(?: v| version)? ?3(?: 0)? | agpl 3 0(?: only| or later)? | gnu org licenses agpl(?: 3 0)?
agpl-3 | affero | gnu affero general public license(?: agpl)?(?:(?: v| version) ?3(?: 0)?)? | - | -
gfdl | free documentation | gnu free documentation license(?:(?: v| version) ?1 [123])? | - | gnu org licenses (?:fdl|gfdl)
gfdl | gfdl | gfdl(?: v| version)?(?: ?1 [123])? | gfdl 1 [123](?: only| or later)? | -
bsd-2 | bsd | (?:bsd 2(?: clause)?|2 clause bsd|two clause bsd|simplified bsd|freebsd) | bsd 2 clause | opensource org licenses? bsd 2 clause
bsd-3 | bsd | (?:bsd 3(?: clause)?|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd) | bsd 3 clause | opensource org licenses? bsd 3 clause
bsd-4 | bsd | (?:bsd 4 clause|4 clause bsd|original bsd) | bsd 4 clause | -
bsd-0 | bsd | (?:0bsd|zero clause bsd|bsd zero clause) | 0bsd | opensource org licenses? 0bsd
bsd | bsd | bsd(?: style)? | - | opensource org licenses? bsd license
isc | isc | isc | isc | opensource org licenses? isc
mpl-1.1 | mozilla | mozilla public license(?: mpl)?(?: v| version)? ?1 1 | - | mozilla org mpl mpl 1 1
mpl-2 | mozilla | mozilla public license(?: mpl)?(?: v| version)? ?2(?: 0)? | - | mozilla org (?:en us )?mpl 2 0
mpl-2 | mpl | mpl(?: v| version)? ?2(?: 0)? | mpl 2 0 | -
mpl | mozilla | mozilla public license | - | -
epl-1 | eclipse | eclipse public license(?: epl)?(?: v| version)? ?1(?: 0)? | - | eclipse org legal epl v10
epl-2 | eclipse | eclipse public license(?: epl)?(?: v| version)? ?2(?: 0)? | - | eclipse org legal epl (?:v20|2 0)
epl-1 | epl | epl(?: v)? ?1(?: 0)? | epl 1 0 | -
epl-2 | epl | epl(?: v)? ?2(?: 0)? | epl 2 0 | -
cddl | cddl | cddl(?: v| version)?(?: ?1 [01])? | cddl 1 [01] | opensource org licenses? cddl
cddl | common development | common development and distribution license(?: cddl)? | - | -
cpl | common public | common public license(?:(?: v| version)? ?1 0)? | - | -
eupl | european union public | european union public licen[cs]e(?:(?: v| version)? ?1 [12])? | - | -
eupl | eupl | eupl(?: v)?(?: ?1 [12])? | eupl 1 [12] | -
artistic-1 | artistic | artistic license(?: v| version)? ?1(?: 0)? | artistic 1 0(?: perl)? | opensource org licenses? artistic license 1 0
artistic-2 | artistic | artistic license(?: v| version)? ?2(?: 0)? | artistic 2 0 | opensource org licenses? artistic license 2 0
artistic | artistic | (?:perl )?artistic | - | -
zlib | zlib | zlib(?: libpng)? | zlib | opensource org licenses? zlib
bsl-1 | boost | boost software license(?:(?: v| version)? ?1(?: 0)?)? | - | boost org license 1 0
bsl-1 | bsl | bsl ?1 0 | bsl 1 0 | -
busl | business source | business source license(?:(?: v| version)? ?1 1)? | busl 1 1 | mariadb com bsl11
unlicense | unlicense | (?:the )?unlicense | unlicense | unlicense org
wtfpl | wtfpl | wtfpl(?:(?: v| version)? ?2)? | wtfpl | wtfpl net
wtfpl | do what the | do what the f\w* you want to public license | - | -
cc0 | cc0 | cc0(?: ?1 0)?(?: universal)? | cc0 1 0 | creativecommons org publicdomain zero 1 0
cc-by | cc by | cc by(?: [1234] [05])?(?! (?:nc|sa|nd)) | cc by [1234] [05] | creativecommons org licenses by [1234] [05]
cc-by-sa | cc by sa | cc by sa(?: [1234] [05])? | cc by sa [1234] [05] | creativecommons org licenses by sa [1234] [05]
cc-by-nd | cc by nd | cc by nd(?: [1234] [05])? | cc by nd [1234] [05] | creativecommons org licenses by nd [1234] [05]
cc-by-nc | cc by nc | cc by nc(?: [1234] [05])?(?! (?:sa|nd)) | cc by nc [1234] [05] | creativecommons org licenses by nc [1234] [05]
cc-by-nc-sa | cc by nc sa | cc by nc sa(?: [1234] [05])? | cc by nc sa [1234] [05] | creativecommons org licenses by nc sa [1234] [05]
cc-by-nc-nd | cc by nc nd | cc by nc nd(?: [1234] [05])? | cc by nc nd [1234] [05] | creativecommons org licenses by nc nd [1234] [05]
cc-by | creative commons | creative commons attribution(?: [1234] [05])?(?! ?(?:non ?commercial|share|no ?deriv)) | - | -
cc-by-sa | creative commons | creative commons attribution share ?alike(?: [1234] [05])? | - | -
cc-by-nd | creative commons | creative commons attribution no ?deriv\w*(?: [1234] [05])? | - | -
cc-by-nc | creative commons | creative commons attribution non ?commercial(?: [1234] [05])?(?! ?(?:share|no ?deriv)) | - | -
cc-by-nc-sa | creative commons | creative commons attribution non ?commercial share ?alike(?: [1234] [05])? | - | -
cc-by-nc-nd | creative commons | creative commons attribution non ?commercial no ?deriv\w*(?: [1234] [05])? | - | -
cc | creative commons | creative commons | - | creativecommons org licenses
odbl | open database | open database license(?: odbl)? | odbl 1 0 | opendatacommons org licenses odbl
odc-by | open data commons | open data commons attribution license(?: odc by)? | odc by 1 0 | opendatacommons org licenses by
pddl | public domain dedication | (?:odc )?public domain dedication and license(?: pddl)? | pddl 1 0 | opendatacommons org licenses pddl
ogl-uk | open government | open government licen[cs]e(?: v[123](?: 0)?)? | ogl uk [123] 0 | nationalarchives gov uk doc open government licence
ofl | open font | (?:sil )?open font license(?:(?: v| version)? ?1 [01])? | ofl 1 [01] | scripts sil org ofl
psf | python software | python software foundation license(?:(?: v| version)? ?2)? | psf 2 0 | docs python org 3 license
php | php | php license(?:(?: v| version)? ?3(?: 01)?)? | php 3 01 | php net license
ruby | ruby | ruby license | ruby | -
openssl | openssl | openssl license | openssl | openssl org source license
postgresql | postgresql | postgresql licen[cs]e | postgresql | postgresql org about licen[cs]e
ncsa | ncsa | (?:university of illinois )?ncsa(?: open source)? | ncsa | opensource org licenses? ncsa
ms-pl | microsoft public | microsoft public license(?: ms pl)? | ms pl | opensource org licenses? ms pl
ms-rl | microsoft reciprocal | microsoft reciprocal license(?: ms rl)? | ms rl | opensource org licenses? ms rl
osl-3 | open software | open software license(?:(?: v| version)? ?3(?: 0)?)? | osl 3 0 | opensource org licenses? osl 3 0
afl-3 | academic free | academic free license(?:(?: v| version)? ?3(?: 0)?)? | afl 3 0 | opensource org licenses? afl 3 0
sspl | server side public | server side public license(?: sspl)?(?:(?: v| version)? ?1)? | sspl 1 0 | mongodb com licensing server side public license
elastic-2 | elastic license | elastic license(?:(?: v| version)? ?2(?: 0)?)? | elastic 2 0 | elastic co licensing elastic license
polyform-nc | polyform | polyform noncommercial license(?: 1 0 0)? | polyform noncommercial 1 0 0 | polyformproject org licenses noncommercial
openrail | rail | (?:creativeml |bigscience )?open ?rail(?: m)? | openrail | -
llama | llama | llama ?[23](?: [123])? community | llama ?[23](?: [123])? | -
blueoak | blue oak | blue oak model license(?: 1 0 0)? | blueoak 1 0 0 | blueoakcouncil org license 1 0 0
upl | universal permissive | universal permissive license(?: upl)?(?: 1 0)? | upl 1 0 | opensource org licenses? upl
vim | vim | vim | vim | -
tex-lppl | latex project | latex project public license(?: lppl)?(?:(?: v| version)? ?1 3c?)? | lppl 1 3c? | latex project org lppl
curl | curl | curl | curl | curl se docs copyright
json | json | json | json | json org license
libpng | libpng | libpng(?: license)?(?: version 2)? | libpng(?: 2 0)? | libpng org pub png src libpng license
x11 | x11 | x11 | x11 | -
""".strip()  # fmt: skip

#: Sentences and phrases of their own: label | priority | keyword | pattern.
_SENTENCES = r"""
mit | 95 | permission is hereby | permission is hereby granted free of charge to any person obtaining a copy
mit | 70 | without restriction | deal in the software without restriction including without limitation the rights to use
isc | 95 | permission to use copy | permission to use copy modify and or distribute this software for any purpose with or without fee
bsd | 90 | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
bsd-3 | 92 | neither the name | neither the name of [^|]{1,80}? may be used to endorse or promote products
bsd-4 | 93 | all advertising materials | all advertising materials mentioning features or use of this software must display
gpl | 85 | this program is free | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
lgpl | 86 | this library is free | this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
gpl-2 | 96 | gnu general | gnu general public license as published by the free software foundation either version 2
gpl-3 | 96 | gnu general | gnu general public license as published by the free software foundation either version 3
lgpl-2.1 | 96 | gnu l | gnu (?:lesser|library) general public license as published by the free software foundation either version 2(?: 1)?
lgpl-3 | 96 | gnu l | gnu lesser general public license as published by the free software foundation either version 3
agpl-3 | 96 | affero | gnu affero general public license as published by the free software foundation either version 3
apache-2 | 94 | apache | you may not use this file except in compliance with the license you may obtain a copy of the license at [^|]{0,60}?apache org
apache-2 | 90 | apache | terms and conditions for use reproduction and distribution [^|]{0,60}?apache
mpl-2 | 95 | mozilla | this source code form is subject to the terms of the mozilla public license(?: v)? 2 0
mpl-1.1 | 95 | mozilla | the contents of this file are subject to the mozilla public license version 1 1
epl-2 | 95 | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license(?: v| version)? ?2
epl-1 | 95 | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license(?: v| version)? ?1
cddl | 90 | common development | subject to the terms of the common development and distribution license
zlib | 95 | as is without any express | this software is provided as is without any express or implied warranty in no event will the authors be held liable
bsl-1 | 95 | boost | distributed under the boost software license version 1 0
unlicense | 95 | released into the public | this is free and unencumbered software released into the public domain
public-domain | 60 | public domain | (?:is|are|was|were|placed|released|dedicated|put) (?:in|into|to) the public domain
public-domain | 55 | public domain | public domain (?:dedication|mark|work|software)
public-domain | 58 | creativecommons org publicdomain | creativecommons org publicdomain mark 1 0
wtfpl | 90 | do what the | you just do what the f\w* you want to
cc-by-sa | 85 | text of this | text of this (?:wikipedia )?article is available under the creative commons attribution share ?alike
gfdl | 85 | free documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
proprietary | 50 | all rights reserved | all rights reserved
proprietary | 52 | alle rechte vorbehalten | alle rechte vorbehalten
proprietary | 52 | tous droits | tous droits r\S*serv\S*s
proprietary | 52 | todos los derechos | todos los derechos reservados
proprietary | 60 | proprietary | proprietary and confidential
proprietary | 58 | unauthorized | unauthorized (?:copying|reproduction|distribution|use) (?:of this [a-z]+ )?(?:[a-z ]{0,30})?is (?:strictly )?prohibited
proprietary | 56 | may not be | may not be (?:reproduced|copied|distributed|published|broadcast|rewritten)(?: or [a-z]+)? (?:or [a-z]+ )?(?:in any form )?without (?:the )?(?:prior )?(?:written )?(?:permission|consent)
proprietary | 54 | end user licen | end user licen[cs]e agreement
proprietary | 54 | subject to the terms of use | use of this (?:site|website|service) is subject to the terms of use
no-commercial | 48 | commercial use | (?:for )?non ?commercial use only
no-commercial | 48 | commercial use | (?:no|not for) commercial use
no-derivatives | 46 | derivative | no derivatives? works?
""".strip()  # fmt: skip

#: Priority of the rules made from a license's name, identifier and address.
TAG, ADDRESS, NOTICE, TITLE = 100, 90, 80, 40
_NOTICE = (
    r"(?:licen[cs]ed|released|distributed|published|available|provided|offered|redistributed|covered|shared|used) "
    r"(?:[a-z]+ ){0,2}?under (?:the |a |an )?(?:terms? (?:and conditions )?of )?(?:the |a |an )?"
)


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str
    pattern: str


def rules() -> list[Rule]:
    """All rules, the more trusted first; among equals as they stand in the tables."""
    out = [Rule(label, 99, phrase, re.escape(phrase).replace(r"\ ", " ")) for phrase, label in BASE.items()]
    for line in _LICENSES.splitlines():
        label, keyword, name, tag, address = (x.strip() for x in line.split(" | "))
        out.append(Rule(label, NOTICE, keyword, rf"{_NOTICE}(?:{name})(?: licen[cs]e)?"))
        out.append(
            Rule(label, TITLE, keyword, rf"(?:{name})" + ("" if "licen" in name or "cc" in name else " licen[cs]e"))
        )
        if tag != "-":
            out.append(Rule(label, TAG, "spdx license", rf"spdx license identifier {tag}"))
            out.append(Rule(label, TAG - 5, "licen", rf"licen[cs]e(?: id| identifier| name)? (?:is )?{tag}"))
        if address != "-":
            out.append(Rule(label, ADDRESS, address.split(" ")[0], address))
    for line in _SENTENCES.splitlines():
        label, priority, keyword, pattern = (x.strip() for x in line.split(" | "))
        out.append(Rule(label, int(priority), keyword, pattern))
    return sorted(out, key=lambda r: -r.priority)


_DROP = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def plain_words(text: str | None) -> str:
    """The text's words, A-Z in lower case, joined by single spaces, with a space at either end."""
    data = (text or "").encode("utf-8", "replace").lower().translate(_DROP)
    return f" {b' '.join(data.split()).decode()} "


class Scanner:
    """Finds the rules' places in texts; a rule runs only where its keyword occurs."""

    def __init__(self) -> None:
        import ahocorasick

        self.rules = rules()
        self.patterns = [re.compile(rf"(?<= )(?:{r.pattern})(?= )") for r in self.rules]
        self.by_keyword: dict[str, list[int]] = {}
        for i, rule in enumerate(self.rules):
            self.by_keyword.setdefault(rule.keyword, []).append(i)
        self.keywords = ahocorasick.Automaton()
        for keyword in self.by_keyword:
            self.keywords.add_word(keyword, keyword)
        self.keywords.make_automaton()

    def found(self, words: str) -> list[tuple[int, int, Rule]]:
        """(start, end, rule), characters, before suppression, in the rules' order."""
        present = {keyword for _, keyword in self.keywords.iter(words)}
        hits = []
        for i in sorted(i for keyword in present for i in self.by_keyword[keyword]):
            hits += [(m.start(), m.end(), self.rules[i]) for m in self.patterns[i].finditer(words)]
        return hits


class _Reach:
    """The largest value put so far at any place up to a given one; both in logarithmic time."""

    def __init__(self, places: int) -> None:
        self.best = [-math.inf] * (places + 1)

    def put(self, at: int, value: int) -> None:
        at += 1
        while at < len(self.best):
            self.best[at] = max(self.best[at], value)
            at += at & -at

    def upto(self, at: int) -> float:
        at, out = at + 1, -math.inf
        while at:
            out = max(out, self.best[at])
            at -= at & -at
        return out


def _places(starts: Iterable[int]) -> dict[int, int]:
    return {start: i for i, start in enumerate(sorted(set(starts)))}


def kept(hits: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Hits that no more trusted hit contains, by start.

    Taken in order of priority, then length, then place; a hit inside an interval already kept is
    suppressed. So is a less trusted longer one around it when both name the same license. An
    interval contains a hit if it starts no later and ends no earlier: of those that start no later
    the furthest end decides, of a label's that start no earlier the nearest end.
    """
    out: list[tuple[int, int, Rule]] = []
    place = _places(h[0] for h in hits)
    furthest = _Reach(len(place))
    of_label: dict[str, list[int]] = {}
    for start, _, rule in hits:
        of_label.setdefault(rule.label, []).append(start)
    own = {label: _places(starts) for label, starts in of_label.items()}
    nearest = {label: _Reach(len(places)) for label, places in own.items()}
    for hit in sorted(hits, key=lambda h: (-h[2].priority, h[0] - h[1], h[0], h[2].label)):
        start, end, label = hit[0], hit[1], hit[2].label
        back = len(own[label]) - 1 - own[label][start]
        if furthest.upto(place[start]) >= end or nearest[label].upto(back) >= -end:
            continue
        out.append(hit)
        furthest.put(place[start], end)
        nearest[label].put(back, -end)
    return sorted(out, key=lambda h: (h[0], h[1], h[2].label))


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, detections (label, start, length in words, priority) and the base places of
    each row of ``docs`` (doc_id, text): n_base, first_word, last_word, base_labels, labels, score.

    Null and empty texts have no words, places or labels and score 0. Base phrases are found
    everywhere and never suppressed; a text with many hits is resolved as a whole. score is the
    chance that some detection is right if each is with its priority's percent. Rows are taken one
    by one, whatever their ids; other columns are ignored. No rows give no rows.
    """
    detection = pa.struct(
        [("label", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("priority", pa.int32())]
    )
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("n_base", pa.int64()),
            ("first_word", pa.int64()),
            ("last_word", pa.int64()),
            ("base_labels", pa.string()),
            ("labels", pa.string()),
            ("score", pa.float64()),
            ("detections", pa.list_(detection)),
        ]
    )

    def one(scanner: Scanner, text: str | None) -> tuple:
        words = plain_words(text)
        gaps = words.count(" ")
        n_words = gaps - 1 if len(words) > 2 else 0
        hits = scanner.found(words)
        if not hits:
            return n_words, 0, None, None, "", "", 0.0, []
        at = np.flatnonzero(np.frombuffer(words.encode("utf-32-le"), dtype=np.uint32) == 32)
        # A hit starts right after the gap before its first word.
        where = lambda c: int(np.searchsorted(at, c)) - 1
        base = [(where(h[0]), h[2].label) for h in hits if h[2].keyword in BASE and h[2].priority == 99]
        final = kept(hits)
        wrong = 1.0
        for h in final:
            wrong *= 1 - h[2].priority / 101
        return (
            n_words,
            len(base),
            min((b[0] for b in base), default=None),
            max((b[0] for b in base), default=None),
            ",".join(sorted({b[1] for b in base})),
            ",".join(sorted({b[1] for b in base} | {h[2].label for h in final})),
            1 - wrong,
            [(h[2].label, where(h[0]), where(h[1] + 1) - where(h[0]), h[2].priority) for h in final],
        )

    names = [f.name for f in detection]

    def run(batches):
        scanner = Scanner()
        for batch in slices(batches):
            rows = [one(scanner, t) for t in batch["text"].to_pylist()]
            columns = list(zip(*rows))
            columns[-1] = [[dict(zip(names, d)) for d in x] for x in columns[-1]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, type=f.type) for c, f in zip(columns, list(schema)[1:]))],
                schema=schema,
            )

    return arrow_map(
        docs.select("doc_id", "text"),
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, "
        "detections array<struct<label: string, start: long, length: long, priority: int>>",
    )
