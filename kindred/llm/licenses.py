"""Licence scan with a positional index of rare tokens.

Every licence template is indexed by its rare words: (template, position) of at most RARE words of highest
inverse template frequency, none of which stands in more than COMMON of all templates; words such as "the" or "license" are
never looked up. The postings of a file's licence words are intersected by relative position: place in the
file less place in the template, give or take the template's shift (SHIFT words, and one in twenty of its length). Where
one alignment covers at least COVER of the template's weight and all of its mandatory key phrases stand in
that part of the file, the file has the label. Base phrases label it wherever their words stand consecutively.

Defined results: words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the A-Z lower-cased text; null and empty
texts have none, no label and score 0. The score is the greatest share of a template's weight that a labelling
alignment covers, 1 with a base phrase. Very long texts take time and memory in proportion to their words.
Repeated rows are scanned each for itself.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame

from . import base

#: Base phrases and their labels (fixed values).
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Licence templates: label, text, mandatory key phrases (fixed values: the words of public licences; whole short
#: licences, the openings of long ones, and the notices and identifiers that files carry instead).
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software", ("permission is hereby granted free of charge", "sublicense and or sell copies")),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", ("permission is hereby granted free of charge", "sublicense and or sell copies")),
    ("mit", "released under the terms of the mit license", ("mit license",)),
    ("mit", "spdx license identifier mit", ("identifier mit",)),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license", ("apache license version 2 0",)),
    ("apache-2", "apache license version 2 0 january 2004 http www apache org licenses terms and conditions for use reproduction and distribution 1 definitions license shall mean the terms and conditions for use reproduction and distribution as defined by sections 1 through 9 of this document licensor shall mean the copyright owner or entity authorized by the copyright owner that is granting the license legal entity shall mean the union of the acting entity and all other entities that control are controlled by or are under common control with that entity", ("terms and conditions for use reproduction and distribution", "licensor shall mean the copyright owner")),
    ("apache-2", "spdx license identifier apache 2 0", ("identifier apache 2 0",)),
    ("bsd-3-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed", ("redistribution and use in source and binary forms", "endorse or promote products")),
    ("bsd-2-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed", ("redistributions of source code must retain", "with the distribution this software is provided")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software", ("with or without fee is hereby granted provided that",)),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness", ("with or without fee is hereby granted the software",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions the origin of this software must not be misrepresented you must not claim that you wrote the original software", ("must not be misrepresented",)),
    ("bsl-1", "boost software license version 1 0 august 17th 2003 permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software", ("boost software license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain", ("free and unencumbered software",)),
    ("wtfpl", "do what the fuck you want to public license version 2 december 2004 everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed", ("what the fuck you want to public license",)),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", ("gnu general public license", "either version 3")),
    ("gpl-3", "gnu general public license version 3 29 june 2007 copyright c 2007 free software foundation inc everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed preamble the gnu general public license is a free copyleft license for software and other kinds of works", ("version 3 29 june 2007", "free copyleft license")),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", ("gnu general public license", "either version 2")),
    ("gpl-2", "gnu general public license version 2 june 1991 everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed preamble the licenses for most software are designed to take away your freedom to share and change it by contrast the gnu general public license is intended to guarantee your freedom to share and change free software", ("version 2 june 1991", "designed to take away your freedom")),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    ("agpl-3", "licensed under the gnu affero general public license version 3", ("gnu affero general public license",)),
    ("agpl-3", "gnu affero general public license version 3 19 november 2007 everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed preamble the gnu affero general public license is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation with the community in the case of network server software", ("gnu affero general public license version 3 19 november 2007",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0", ("mozilla public license v 2 0",)),
    ("mpl-2", "mozilla public license version 2 0 1 definitions 1 1 contributor means each individual or legal entity that creates contributes to the creation of or owns covered software 1 2 contributor version means the combination of the contributions of others", ("mozilla public license version 2 0", "owns covered software")),
    ("epl-2", "the accompanying program is provided under the terms of this eclipse public license agreement any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement", ("eclipse public license",)),
    ("cc0", "dedicated to the public domain under the creative commons cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial 4 0 international license",)),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc-by", "by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons attribution 4 0 international public license", ("creative commons attribution 4 0 international public license",)),
)

#: Words of a template that are looked up at most; the share of templates in which such a word may stand; words by which places
#: may be off, in any template and in one so long; the least share of weight.
RARE, COMMON, SHIFT, PER_WORDS, COVER = 12, 0.25, 3, 20, 0.6


class Templates:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.templates = [(label, base.words(text.encode()), [base.words(p.encode()) for p in keys]) for label, text, keys in templates]
        df = Counter(w for _, words, _ in self.templates for w in set(words))
        idf = {w: math.log((1 + len(self.templates)) / (1 + n)) + 1 for w, n in df.items()}
        most = max(1, COMMON * len(self.templates))
        self.postings: dict[bytes, list[tuple[int, int, float]]] = defaultdict(list)
        self.total: list[float] = []
        for t, (_, words, _) in enumerate(self.templates):
            first = {w: p for p, w in reversed(list(enumerate(words)))}
            chosen = sorted((w for w in first if df[w] <= most), key=lambda w: (-idf[w], first[w]))[:RARE]
            for w in chosen:
                self.postings[w].append((t, first[w], idf[w]))
            self.total.append(sum(idf[w] for w in chosen))
        self.postings = dict(self.postings)
        self.shift = [SHIFT + len(words) // PER_WORDS for _, words, _ in self.templates]
        # a text with none of these words can't hold all key phrases of any template, nor a base phrase
        self.phrases = [(base.words(p.encode()), label) for p, label in phrases.items()]
        often = Counter(w for _, _, keys in self.templates for w in set(keys[0]))
        self.gate = frozenset(max(keys[0], key=lambda w: (-df[w], -often[w], len(w), w)) for _, _, keys in self.templates) | {max(p, key=lambda w: (-df[w], len(w), w)) for p, _ in self.phrases}

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], set[str], float]:
        """Base places (start, label), labels of the templates, score."""
        if self.gate.isdisjoint(words):
            return [], set(), 0.0
        places = sorted((at, label) for phrase, label in self.phrases for at in _find(words, phrase))
        hits: dict[int, list[tuple[int, int, float]]] = defaultdict(list)  # by template: relative position, place in the template, weight
        get = self.postings.get
        for i, w in enumerate(words):
            for t, p, weight in get(w, ()):
                hits[t].append((i - p, p, weight))
        labels, best = set(), 0.0
        for t, found in hits.items():
            if (share := self._aligned(t, sorted(found), words)) > 0:
                labels.add(self.templates[t][0])
                best = max(best, min(1.0, share))
        return places, labels, 1.0 if places else best

    def _aligned(self, t: int, hits: list[tuple[int, int, float]], words: list[bytes]) -> float:
        """The greatest share of the template's weight in a window of relative positions that also has the key phrases; 0 if none reaches COVER."""
        _, text, keys = self.templates[t]
        width, least = 2 * self.shift[t], COVER * self.total[t]
        if sum({p: w for _, p, w in hits}.values()) < least - 1e-9:
            return 0.0
        at: list[list[int]] | None = None
        inside: Counter[int] = Counter()
        best = weight = 0.0
        end = 0
        for start, (first, place, w) in enumerate(hits):
            while end < len(hits) and hits[end][0] <= first + width:
                _, p, x = hits[end]
                weight += x if not inside[p] else 0.0
                inside[p] += 1
                end += 1
            if weight > best + 1e-9 and weight >= least - 1e-9:
                at = at or [_find(words, k) for k in keys]
                # the part of the file that the template covers at any of these relative positions
                low, high = first - self.shift[t], first + width + self.shift[t] + len(text)
                if all((j := bisect_left(a, low)) < len(a) and a[j] + len(k) <= high for a, k in zip(at, keys, strict=True)):
                    best = weight
            inside[place] -= 1
            weight -= w if not inside[place] else 0.0
        return best / self.total[t] if best else 0.0


def _find(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Where phrase stands in words."""
    out, at, n = [], -1, len(phrase)
    try:
        while True:
            at = words.index(phrase[0], at + 1)
            if words[at : at + n] == phrase:
                out.append(at)
    except ValueError:
        return out


def scan_licenses(documents: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """The contract columns for every whole text: places of base phrases, base labels, all labels, score."""
    index = documents.sparkSession.sparkContext.broadcast(Templates(templates, phrases))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for t in base.utf8(b["text"]):
            places, labels, score = index.value.scan(w := base.words(t))
            own = {label for _, label in places}
            rows.append((len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted(own)), ",".join(sorted(own | labels)), score))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        return pa.RecordBatch.from_arrays([b["doc_id"], *[pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]], names)

    return base.map_arrow(base.texts_of(documents, "doc_id", "text"), fn, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
