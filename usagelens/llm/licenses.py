"""License scans by ordered signature rules. DataFrame functions only.

A text is lower-cased (A-Z), its words are joined by single spaces, and rules are regular expressions over that line of
words. A rule runs only where its keyword occurs. Of overlapping detections, one that lies inside another's words is suppressed if it has the lower
priority, or the same and fewer words; equal spans of equal priority both stay.

Defined cases: null text is empty: no words, no labels, score 0; long texts are scanned whole; repeated rows are rows of their
own; an empty table gives no rows; clashing or extra columns are left out of the result.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.detect import literal_pattern

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The phrases whose places are counted, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Rule:
    """`pattern` over words joined by spaces; `keyword` must occur first; a larger `priority` wins; `weight` is how sure the rule is.

    `gate`: rarer words than the keyword, or their beginnings, one of which every match holds where a word begins; without them the
    keyword is the rule's gate, wherever it stands.
    """

    label: str
    pattern: str
    keyword: str
    priority: int
    weight: float
    gate: tuple[str, ...] = ()


#: Names by label: (alternative wordings, keyword that each of them holds).
NAMES: dict[str, tuple[Sequence[str], str]] = {
    "mit": (["mit", "expat", "massachusetts institute of technology"], ""),
    "apache-1.1": (["apache(?: software)?(?: license)? version 1 1", "apache 1 1"], "apache"),
    "apache-2.0": (["apache(?: software)?(?: license)?(?: version)? 2 0", "apache2", "asl 2 0", "al2"], ""),
    "gpl-1.0": (["(?:gnu )?gpl ?v?1(?: 0)?(?: only| or later)?", "general public license version 1"], ""),
    "gpl-2.0": (["(?:gnu )?gpl ?v?2(?: 0)?(?: only| or later)?", "general public license(?: version| v) ?2", "version 2 of the gnu general public"], ""),
    "gpl-3.0": (["(?:gnu )?gpl ?v?3(?: 0)?(?: only| or later)?", "general public license(?: version| v) ?3", "version 3 of the gnu general public"], ""),
    "lgpl-2.1": (["(?:gnu )?lgpl ?v?2 1(?: only| or later)?", "lesser general public license(?: version| v) ?2 1"], ""),
    "lgpl-3.0": (["(?:gnu )?lgpl ?v?3(?: 0)?(?: only| or later)?", "lesser general public license(?: version| v) ?3"], ""),
    "agpl-3.0": (["(?:gnu )?agpl ?v?3(?: 0)?(?: only| or later)?", "affero general public license(?: version| v)? ?3?"], ""),
    "bsd-2-clause": (["bsd 2 clause", "simplified bsd", "freebsd"], "bsd"),
    "bsd-3-clause": (["bsd 3 clause", "new bsd", "modified bsd", "revised bsd"], "bsd"),
    "bsd-4-clause": (["bsd 4 clause", "original bsd"], "bsd"),
    "0bsd": (["0bsd", "zero clause bsd"], "bsd"),
    "isc": (["isc", "internet systems consortium"], ""),
    "mpl-1.1": (["mozilla public license(?: version| v)? 1 1", "mpl 1 1"], ""),
    "mpl-2.0": (["mozilla public license(?: version| v)? 2 0", "mpl 2 0"], ""),
    "epl-1.0": (["eclipse public license(?: version| v)? 1 0", "epl 1 0"], ""),
    "epl-2.0": (["eclipse public license(?: version| v)? 2 0", "epl 2 0"], ""),
    "cddl-1.0": (["common development and distribution license", "cddl 1 0"], ""),
    "cc0-1.0": (["cc0(?: 1 0)?", "creative commons zero"], ""),
    "cc-by-4.0": (["cc by 4 0", "creative commons attribution 4 0"], ""),
    "cc-by-sa-4.0": (["cc by sa 4 0", "creative commons attribution sharealike 4 0"], ""),
    "cc-by-nc-4.0": (["cc by nc 4 0", "creative commons attribution noncommercial 4 0"], ""),
    "unlicense": (["unlicense"], "unlicense"),
    "wtfpl": (["wtfpl", "do what the f[a-z]* you want"], ""),
    "zlib": (["zlib(?: libpng)?"], "zlib"),
    "bsl-1.0": (["boost software license(?: version)? 1 0", "bsl 1 0"], ""),
    "artistic-2.0": (["artistic license(?: version)? 2 0", "artistic 2 0"], "artistic"),
    "python-2.0": (["python software foundation", "psf(?: 2 0)?"], ""),
    "postgresql": (["postgresql"], "postgresql"),
    "ofl-1.1": (["sil open font", "ofl 1 1"], ""),
    "ms-pl": (["microsoft public", "ms pl"], ""),
    "eupl-1.2": (["european union public(?: licence| license)?(?: version| v)?(?: 1 2)?", "eupl 1 2"], ""),
    "upl-1.0": (["universal permissive(?: license)?(?: version| v)?(?: 1 0)?", "upl 1 0"], ""),
    "ncsa": (["university of illinois ncsa", "ncsa"], "ncsa"),
    "openssl": (["openssl(?: ssleay)?"], "openssl"),
    "proprietary": (["proprietary", "commercial"], ""),
}

#: " of " is in nearly all texts; what stands before it in the form isn't.
GATES = {" of ": (" terms of ", " conditions of ")}

#: How a text refers to a name: (form, keyword of the form, priority, weight).
FORMS = [
    (r"spdx license identifier {n}", "spdx", 90, 0.99),
    (r"(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?{n}(?: license| licence)?", " under ", 70, 0.95),
    (r"(?:subject to|governed by|under) (?:the )?(?:terms|conditions|terms and conditions) of (?:the )?{n}(?: license| licence)?", " of ", 65, 0.9),
    (r"{n} (?:license|licence)", "licen", 50, 0.85),
    (r"(?:license|licence) {n}", "licen", 40, 0.7),
    (r"permission (?:is )?(?:hereby )?granted (?:[a-z]+ ){{0,6}}{n}", "permission", 35, 0.6),
]

#: Signatures of the texts themselves and of notices.
TEXTS = [
    Rule("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby", 100, 0.99),
    Rule("apache-2.0", "you may not use this file except in compliance with the license", "in compliance with", 100, 0.99),
    Rule("gpl", "this program is free software you can redistribute it and or modify", "free software", 95, 0.95),
    Rule("bsd-3-clause", "neither the name of (?:[a-z0-9]+ ){1,12}nor the names of its contributors", "neither the name", 100, 0.97),
    Rule("bsd-2-clause", "redistribution and use in source and binary forms with or without modification", "redistribution and use", 80, 0.9),
    Rule("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use", 100, 0.97),
    Rule("zlib", "this software is provided as is without any express or implied warranty in no event", "provided as is", 90, 0.9),
    Rule("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered", 100, 0.99),
    Rule("public-domain", "(?:dedicated|released|placed|in) (?:to|into|in)? ?the public domain", "public domain", 45, 0.7),
    Rule("proprietary", "all rights reserved", "all rights reserved", 30, 0.4),
    Rule("proprietary", "(?:confidential and proprietary|proprietary and confidential)", "proprietary", 60, 0.8),
    Rule("copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]", "copyright", 10, 0.3),
    Rule("gpl", "gnu general public (?:license|licence)", "general public", 48, 0.9),
    Rule("lgpl", "gnu lesser general public (?:license|licence)", "lesser general", 55, 0.9),
    Rule("apache", "apache (?:software )?license", "apache", 45, 0.85),
    Rule("bsd", "bsd (?:style )?(?:license|licence)", "bsd", 45, 0.8),
    Rule("mpl", "mozilla public license", "mozilla", 45, 0.85),
    Rule("cc", "creative commons (?:attribution )?(?:license|licence)", "creative commons", 45, 0.7),
    # permissive texts
    Rule("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "above copyright notice", 92, 0.9),
    Rule("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense", "deal in the software", 92, 0.95),
    Rule("bsd-2-clause", "redistributions of source code must retain the above copyright notice this list of conditions", "redistributions of source", 81, 0.85),
    Rule("bsd-2-clause", "redistributions in binary form must reproduce the above copyright notice", "redistributions in binary", 81, 0.85),
    Rule("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment", "advertising materials", 101, 0.97),
    Rule("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission", "endorse or promote", 98, 0.95),
    Rule("bsd-source-code", "redistributions of source code must retain the above copyright notice and this list of conditions and the following disclaimer only", "redistributions of source", 90, 0.8),
    Rule("isc", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted", "permission to use", 100, 0.95),
    Rule("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided", "permission to use", 101, 0.95),
    Rule("hpnd", "permission to use copy modify and distribute this software and its documentation for any purpose", "permission to use", 97, 0.9),
    Rule("ntp", "permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted provided that", "permission to use", 98, 0.9),
    Rule("x11", "except as contained in this notice the name of (?:[a-z0-9]+ ){1,10}shall not be used in advertising", "except as contained", 99, 0.95),
    Rule("curl", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice", "permission to use", 101, 0.9),
    Rule("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", "must not be misrepresented", 100, 0.98),
    Rule("zlib", "altered source versions must be plainly marked as such", "plainly marked", 95, 0.95),
    Rule("libpng", "the png reference library is supplied as is", "png reference library", 95, 0.95),
    Rule("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "permission is hereby", 101, 0.98),
    Rule("apache-1.1", "this product includes software developed by the apache software foundation", "apache software foundation", 88, 0.85),
    Rule("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "as is basis", 90, 0.95),
    Rule("apache-2.0", "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable", "each contributor hereby grants", 95, 0.97),
    Rule("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", "anyone is free to copy", 95, 0.97),
    Rule("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed", "verbatim or modified", 95, 0.95),
    Rule("beerware", "as long as you retain this notice you can do whatever you want with this stuff", "retain this notice", 95, 0.97),
    Rule("beerware", "the beer ware license", "beer ware", 90, 0.9),
    Rule("json", "the software shall be used for good not evil", "good not evil", 95, 0.98),
    Rule("fair", "usage of the works is permitted provided that this instrument is retained with the works", "usage of the works", 95, 0.97),
    Rule("icu", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction (?:[a-z]+ ){5,30}provided that the above copyright notice", "permission is hereby", 101, 0.85),
    Rule("unicode", "unicode license agreement data files and software", "unicode license", 95, 0.95),
    Rule("vim", "there are no restrictions on distributing unmodified copies of vim", "copies of vim", 95, 0.97),
    Rule("php-3.01", "this product includes php software freely available from", "php software", 92, 0.95),
    Rule("openssl", "this product includes software developed by the openssl project", "openssl project", 95, 0.97),
    Rule("openssl", "this product includes cryptographic software written by eric young", "eric young", 95, 0.97),
    Rule("python-2.0", "psf hereby grants licensee a nonexclusive royalty free world wide license", "hereby grants licensee", 95, 0.97),
    Rule("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "written agreement", 101, 0.97),
    Rule("ncsa", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers", "following disclaimers", 96, 0.85),
    Rule("afl-3.0", "licensed under the academic free license version 3 0", "academic free", 90, 0.97),
    Rule("naist-2003", "nara institute of science and technology", "nara institute", 60, 0.7),
    Rule("tcl", "the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose", "authors hereby grant", 95, 0.95),
    Rule("ruby", "you may make and give away verbatim copies of the source form of the software without restriction", "give away verbatim", 92, 0.9),
    Rule("artistic-1.0", "you may otherwise make your modifications available under the terms of this artistic license|the intent of this document is to state the conditions under which a package may be copied", "", 90, 0.9, ("artistic license", "intent of this document")),
    Rule("artistic-2.0", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed this license establishes the terms under which a given free software package", "given free software", 95, 0.95),
    Rule("upl-1.0", "subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data", "condition set forth", 101, 0.96),
    Rule("blueoak-1.0.0", "blue oak model license", "blue oak", 95, 0.97),
    Rule("mulan-psl-2.0", "mulan permissive software license", "mulan permissive", 95, 0.97),
    Rule("w3c", "permission to copy modify and distribute this work with or without modification for any purpose and without fee or royalty is hereby granted", "fee or royalty", 95, 0.92),
    Rule("ftl", "freetype project license|portions of this software are copyright (?:c )?(?:[0-9]+ )*the freetype project", "freetype project", 92, 0.93),
    # weak and strong copyleft
    Rule("gpl", "either version [0-9] of the license or at your option any later version", "any later version", 72, 0.85),
    Rule("gpl-1.0", "free software foundation either version 1 or at your option any later version", "either version 1", 96, 0.93),
    Rule("gpl-2.0", "free software foundation either version 2 of the license or at your option any later version", "either version 2", 96, 0.97),
    Rule("gpl-2.0", "under the terms of the gnu general public license version 2 as published by the free software foundation", "general public license version 2", 97, 0.97),
    Rule("gpl-3.0", "free software foundation either version 3 of the license or at your option any later version", "either version 3", 96, 0.97),
    Rule("gpl-3.0", "you should have received a copy of the gnu general public license along with this program if not see", "if not see", 60, 0.8),
    Rule("gpl", "you should have received a copy of the gnu general public license along with this program", "gnu general public license along", 58, 0.8),
    Rule("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license along with this", "general public license along", 62, 0.9),
    Rule("agpl-3.0", "you should have received a copy of the gnu affero general public license along with this", "affero general public", 92, 0.95),
    Rule("agpl-3.0", "gnu affero general public license", "affero general public", 85, 0.9),
    Rule("lgpl-2.0", "gnu library general public license(?: as published by the free software foundation either version 2)?", "library general public", 85, 0.9),
    Rule("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu", "this library is free software", 94, 0.93),
    Rule("classpath-exception-2.0", "linking this library statically or dynamically with other modules is making a combined work based on this library", "making a combined work", 98, 0.97),
    Rule("gcc-exception-3.1", "gcc runtime library exception", "runtime library exception", 95, 0.96),
    Rule("bison-exception-2.2", "as a special exception you may create a larger work that contains part or all of the bison parser skeleton", "bison parser", 98, 0.97),
    Rule("autoconf-exception", "as a special exception the free software foundation gives unlimited permission to copy distribute and modify the configure scripts", "configure scripts", 98, 0.96),
    Rule("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "source code form", 100, 0.98),
    Rule("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1", "contents of this file", 100, 0.98),
    Rule("mpl-1.0", "the contents of this file are subject to the mozilla public license version 1 0", "contents of this file", 100, 0.97),
    Rule("npl", "the contents of this file are subject to the netscape public license", "netscape public", 100, 0.97),
    Rule("epl-1.0", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", "accompanying materials", 100, 0.98),
    Rule("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license (?:v ?)?2 0", "accompanying materials", 100, 0.98),
    Rule("cpl-1.0", "common public license(?: version| v)? ?1 0", "common public license", 90, 0.95),
    Rule("ipl-1.0", "ibm public license(?: version| v)? ?1 0", "ibm public license", 90, 0.95),
    Rule("cddl-1.0", "the contents of this file are subject to the terms of the common development and distribution license", "common development", 100, 0.98),
    Rule("cecill", "this software is governed by the cecill(?: [a-z0-9]+)? license under french law", "cecill", 95, 0.97),
    Rule("eupl", "european union public licen[cs]e", "european union public", 80, 0.9),
    Rule("osl-3.0", "licensed under the open software license version 3 0", "open software license", 95, 0.97),
    Rule("qpl-1.0", "the q public license(?: version 1 0)?", "q public license", 90, 0.93),
    Rule("sleepycat", "redistributions in any form must be accompanied by information on how to obtain complete source code for the db software", "accompanied by information", 98, 0.97),
    Rule("rpl", "reciprocal public license(?: version)?(?: 1 [0-9])?", "reciprocal public", 88, 0.93),
    Rule("ms-pl", "microsoft public license ms pl", "microsoft public license", 88, 0.95),
    Rule("ms-rl", "microsoft reciprocal license", "microsoft reciprocal", 88, 0.95),
    Rule("lppl", "latex project public license", "latex project public", 92, 0.96),
    Rule("ofl-1.1", "this font software is licensed under the sil open font license version 1 1", "font software", 98, 0.98),
    Rule("ofl-1.1", "the fonts and derivatives however cannot be released under any other type of license", "fonts and derivatives", 95, 0.95),
    Rule("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "free documentation license", 98, 0.98),
    Rule("gfdl", "gnu free documentation license", "free documentation license", 85, 0.9),
    # works and data
    Rule("cc-by-4.0", "creative commons attribution 4 0 international(?: public)? license", "attribution 4 0 international", 92, 0.97),
    Rule("cc-by-sa-4.0", "creative commons attribution share ?alike 4 0 international(?: public)? license", "creative commons attribution", 92, 0.97),
    Rule("cc-by-nc-4.0", "creative commons attribution non ?commercial 4 0 international(?: public)? license", "creative commons attribution", 92, 0.97),
    Rule("cc-by-nd-4.0", "creative commons attribution no ?deriv(?:ative)?s 4 0 international(?: public)? license", "creative commons attribution", 92, 0.97),
    Rule("cc-by-nc-sa-4.0", "creative commons attribution non ?commercial share ?alike 4 0 international(?: public)? license", "creative commons attribution", 93, 0.97),
    Rule("cc-by-nc-nd-4.0", "creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0 international(?: public)? license", "creative commons attribution", 93, 0.97),
    Rule("cc-by-3.0", "creative commons attribution 3 0 (?:unported|united states|generic)(?: license)?", "attribution 3 0", 92, 0.96),
    Rule("cc-by-sa-3.0", "creative commons attribution share ?alike 3 0(?: unported)?(?: license)?", "creative commons attribution", 91, 0.96),
    Rule("cc0-1.0", "to the extent possible under law (?:[a-z0-9]+ ){1,15}has waived all copyright and related or neighboring rights", "extent possible under law", 98, 0.98),
    Rule("cc0-1.0", "no copyright public domain dedication|cc0 1 0 universal", "", 88, 0.95, ("public domain dedication", "cc0 1 0 universal")),
    Rule("pddl-1.0", "open data commons public domain dedication and licen[cs]e", "open data commons public", 95, 0.97),
    Rule("odbl-1.0", "open (?:data commons open )?database licen[cs]e", "database licen", 90, 0.95),
    Rule("odc-by-1.0", "open data commons attribution licen[cs]e", "open data commons attribution", 92, 0.96),
    Rule("cdla-permissive", "community data license agreement permissive", "community data license", 92, 0.96),
    Rule("cdla-sharing", "community data license agreement sharing", "community data license", 92, 0.96),
    Rule("ogl-uk", "open government licen[cs]e(?: v[0-9](?: 0)?)?", "open government licen", 85, 0.93),
    Rule("us-government-work", "(?:this is )?a work of the (?:united states|u s) government and is not subject to copyright", "government and is not subject", 92, 0.93),
    # source-available, models and closed
    Rule("busl-1.1", "business source license(?: 1 1)?", "business source license", 90, 0.95),
    Rule("sspl-1.0", "server side public license(?: version 1)?", "server side public", 92, 0.97),
    Rule("elastic-2.0", "elastic license(?: version)?(?: 2 0)?", "elastic license", 88, 0.94),
    Rule("commons-clause", "commons clause (?:license )?(?:restriction|condition)", "commons clause", 90, 0.95),
    Rule("polyform-noncommercial-1.0.0", "polyform noncommercial license", "polyform noncommercial", 92, 0.97),
    Rule("confluent-community", "confluent community license(?: agreement)?", "confluent community", 92, 0.96),
    Rule("openrail", "(?:creativeml|bigscience|bigcode) (?:open ?rail|rail)(?: m)?(?: license)?", "rail", 88, 0.93, ("creativeml", "bigscience", "bigcode")),
    Rule("llama-community", "llama [0-9]?(?: ?[0-9])? ?community license agreement", "community license agreement", 90, 0.95),
    Rule("proprietary", "unauthorized (?:copying|reproduction|use|distribution) of this (?:file|software|document|program|work)(?: via any medium)? is strictly prohibited", "strictly prohibited", 70, 0.9),
    Rule("proprietary", "no part of this (?:publication|book|work|document) may be reproduced", "no part of this", 68, 0.85),
    Rule("proprietary", "this software is the confidential and proprietary information of", "proprietary information of", 75, 0.92),
    Rule("proprietary", "you may not (?:copy|modify|reverse engineer|decompile|disassemble|sell|rent|lease)", "you may not", 50, 0.55),
    Rule("proprietary", "for internal use only", "internal use only", 40, 0.5),
    Rule("non-commercial", "for (?:non commercial|noncommercial|personal|academic|research) (?:use|purposes) only", " only", 46, 0.7, ("commercial use only", "commercial purposes only", "personal use only", "personal purposes only", "academic use only", "academic purposes only", "research use only", "research purposes only")),
    Rule("eula", "end user license agreement", "end user license", 55, 0.75),
    Rule("freeware", "(?:this (?:program|software) is freeware|distributed as freeware)", "freeware", 50, 0.7),
    Rule("shareware", "(?:this (?:program|software) is shareware|distributed as shareware)", "shareware", 50, 0.7),
    Rule("copyright", "(?:c|copr) (?:19|20)[0-9][0-9] [a-z]+ all rights reserved", "all rights reserved", 31, 0.4),
    Rule("public-domain", "no rights reserved", "no rights reserved", 45, 0.7),
    Rule("public-domain", "this (?:file|code|software|work) is (?:hereby )?(?:in|placed in) the public domain", "the public domain", 60, 0.85),
]


def rules() -> list[Rule]:
    """Every name in every form, and the signatures of texts: some hundreds, by priority."""
    out = [r if r.gate else replace(r, gate=(r.keyword,)) for r in TEXTS]  # these keywords begin words
    for label, (wordings, keyword) in NAMES.items():
        for form, form_keyword, priority, weight in FORMS:
            name = "(?:" + "|".join(wordings) + ")"
            out.append(Rule(label, form.format(n=name), keyword or form_keyword, priority, weight, GATES.get(form_keyword, (form_keyword,))))
    return sorted(out, key=lambda r: (-r.priority, r.label, r.pattern))


def gate_words(found: Sequence[Rule]) -> list[str]:
    """Words one of which any text holds that one of these rules matches: the prefilter of whole texts."""
    words = {word for r in found for word in r.gate or (r.keyword,)}
    return sorted(w for w in words if not any(other != w and other in w for other in words))


def _gate(t: Column, found: Sequence[Rule]) -> Column:
    """May any rule match? Gates are looked for at the beginnings of words alone, all in one pass; a rule without one by its keyword anywhere."""
    aligned = [w.lstrip(" ") for w in gate_words([r for r in found if r.gate])]
    test = t.rlike(" " + literal_pattern(aligned)) if aligned else F.lit(False)
    for word in gate_words([r for r in found if not r.gate]):
        test = test | t.contains(word)
    return test


def _spaces(x: Column) -> Column:
    return (F.length(x) - F.length(F.replace(x, F.lit(" ")))).cast("long")


def scan(docs: DataFrame, found: Sequence[Rule] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections), a row for each of `docs`.

    detections: structs (label, start, end, weight), words from 0, `end` exclusive, after suppression.
    """
    found = list(found if found is not None else rules())
    text = F.coalesce("text", F.lit(""))
    # lower() also takes letters beyond A-Z, which no rule has: but for the two whose small form is an ASCII letter, that is the same and much faster
    small = F.when(text.contains("\u212a") | text.contains("\u0130"), F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(text))
    line = F.concat(F.lit(" "), F.trim(F.regexp_replace(small, NOT_WORD, " ")), F.lit(" "))
    df = docs.select("doc_id", line.alias("_t")).withColumn("_n", F.when(F.col("_t") == "  ", F.lit(0)).otherwise(_spaces(F.col("_t")) - 1).cast("long"))
    t = F.col("_t")
    # base phrases: places by plain search; neighbours share a space, so a place ends before it
    count, first, last, labels = F.lit(0).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("long"), []
    hit = t.contains(" license ")
    for phrase, label in BASE.items():
        has = hit & t.contains(f" {phrase} ")
        doubled = F.replace(t, F.lit(" "), F.lit("  "))
        wide = " " + phrase.replace(" ", "  ") + " "
        n = ((F.length(doubled) - F.length(F.replace(doubled, F.lit(wide)))) / len(wide)).cast("long")
        count = count + F.when(has, n).otherwise(0)
        head = F.substring_index(t, f" {phrase} ", 1)
        tail = F.substring_index(t, f" {phrase} ", -1)
        words = phrase.count(" ") + 1
        at_first = F.when(has, _spaces(head))
        at_last = F.when(has, F.col("_n") - F.greatest(_spaces(tail), F.lit(0)) - words)
        first, last = F.least(first, at_first), F.greatest(last, at_last)
        labels.append(F.when(has, F.lit(label)))
    # nulls drop out of least(), greatest() and array_compact()
    base = F.array_sort(F.array_compact(F.array(*labels)))
    gate = _gate(t, found)
    table = F.array(*[F.struct(F.lit(r.label).alias("label"), F.lit(rf"(?<= )(?:{r.pattern})(?= )").alias("re"), F.lit(r.keyword).alias("key"), F.lit(r.priority).alias("pr"), F.lit(r.weight).alias("w")) for r in found])
    table = F.filter(table, lambda r: F.contains(t, r["key"]))

    def hits(r: Column) -> Column:
        texts = F.regexp_extract_all(t, r["re"], F.lit(0))
        gaps = F.split(t, r["re"], -1)
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<s:bigint,e:bigint>>").alias("out"))
        # words before the i-th match: of the gaps and matches before it
        step = lambda acc, x: F.struct((acc["at"] + _spaces(x["g"]) + _spaces(x["m"])).alias("at"), F.concat(acc["out"], F.array(F.struct((acc["at"] + _spaces(x["g"]) - 1).alias("s"), (acc["at"] + _spaces(x["g"]) + _spaces(x["m"])).alias("e")))).alias("out"))
        pairs = F.zip_with(F.slice(gaps, 1, F.size(texts)), texts, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
        spans = F.aggregate(pairs, start, step, lambda acc: acc["out"])
        return F.transform(spans, lambda s: F.struct(r["label"].alias("label"), s["s"].alias("start"), s["e"].alias("end"), r["w"].alias("weight"), r["pr"].alias("pr")))

    raw = F.flatten(F.transform(table, hits))
    none = F.array().cast("array<struct<label:string,start:bigint,end:bigint,weight:double,pr:int>>")
    df = df.withColumn("_raw", F.when(gate, raw).otherwise(none))
    inside = lambda a, b: (
        (b["start"] <= a["start"]) & (a["end"] <= b["end"]) & ((b["pr"] > a["pr"]) | ((b["pr"] == a["pr"]) & ((b["end"] - b["start"]) > (a["end"] - a["start"]))))
    )
    kept = F.filter("_raw", lambda a: ~F.exists("_raw", lambda b: inside(a, b)))
    df = df.withColumn("_kept", F.when(F.size("_raw") > 0, kept).otherwise(F.col("_raw")))
    all_labels = F.array_sort(F.array_distinct(F.concat(base, F.transform("_kept", lambda x: x["label"]))))
    doubt = F.aggregate("_kept", F.lit(1.0), lambda a, x: a * (1 - x["weight"]))
    doubt = doubt * F.when(F.size(base) > 0, 0.2).otherwise(1.0)
    return df.select(
        "doc_id", F.col("_n").alias("n_words"), count.alias("n_base"), first.alias("first_word"), last.alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(all_labels, ",").alias("labels"), (1 - doubt).alias("score"),
        F.transform("_kept", lambda x: F.struct(x["label"].alias("label"), x["start"].alias("start"), x["end"].alias("end"), x["weight"].alias("weight"))).alias("detections"),
    )


ORACLE = r"""
WITH t AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
p AS (
  SELECT doc_id, w,
    list_filter(range(1, len(w)), lambda i: w[i] = 'mit' AND w[i + 1] = 'license') AS m,
    list_filter(range(1, len(w)), lambda i: w[i] = 'apache' AND w[i + 1] = 'license') AS a,
    list_filter(range(1, len(w) - 1), lambda i: w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license') AS g FROM t)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(m) + len(a) + len(g) AS BIGINT) AS n_base,
  CAST(list_min(list_concat(m, a, g)) - 1 AS BIGINT) AS first_word, CAST(list_max(list_concat(m, a, g)) - 1 AS BIGINT) AS last_word,
  array_to_string(list_sort(list_filter([CASE WHEN len(m) > 0 THEN 'mit' END, CASE WHEN len(a) > 0 THEN 'apache' END, CASE WHEN len(g) > 0 THEN 'gpl' END], lambda x: x IS NOT NULL)), ',') AS base_labels
FROM p
"""
