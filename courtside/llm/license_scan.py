"""License scans: ordered signature rules over normalised words.

A text is lower-cased (A-Z) and cut into words of digits, letters and everything beyond ASCII; rules are patterns over the
words with one space between them. Signatures are written out one by one: sentences, notices, addresses and headers of license
texts, some two hundred. Beside them every license name stands in a few forms (``licensed under ...``, ``... license``). A rule
is gated by keywords: its pattern runs only if the text has one of the words that each of its matches must contain. Every rule
has a priority; detections are resolved by it: one that lies inside the interval of a detection of higher priority is
suppressed, and so is one inside a longer interval of the same priority; an exact name (``gnu lesser general public license v2.1``)
outranks a general name in a form inside it. Detections of the base phrases are never suppressed.

A detection lends its meaning to a list: a name that follows it after ``and`` or ``or``, or precedes it, is detected as well, unless the
name is a common word. A detection after ``not`` is none, and neither is what lies inside it. ``license mit`` counts if the license is in capitals or something other than
a word follows, since ``mit`` is also a word.

NULL text counts as empty: no words, no labels, score 0. Whole texts; all places are found.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from courtside.llm.texts import add_from_text

# Fixed values of the base scan.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Licenses: label, names as word patterns, words of which each name has one.
LICENSES = [
    ("mit", ["mit", "expat"]),
    ("mit-0", ["mit 0", "mit no attribution"]),
    ("x11", ["x11"]),
    ("apache-2", ["apache 2(?: 0)?", "apache(?: software)? license(?: version)?(?: v?2(?: 0)?)"]),
    ("apache-1.1", ["apache 1 1", "apache software license version 1 1"]),
    ("bsd", ["bsd"]),
    ("bsd-2-clause", ["bsd 2 clause", "2 clause bsd", "simplified bsd", "freebsd"]),
    ("bsd-3-clause", ["bsd 3 clause", "3 clause bsd", "new bsd", "modified bsd", "revised bsd"]),
    ("bsd-4-clause", ["bsd 4 clause", "4 clause bsd", "original bsd"]),
    ("0bsd", ["0bsd", "zero clause bsd"]),
    ("isc", ["isc"]),
    ("gpl-2.0", ["gplv2", "gpl(?: version)? v?2(?: 0)?(?: only| or later)?", "gnu general public license(?: version| v) ?2"]),
    ("gpl-3.0", ["gplv3", "gpl(?: version)? v?3(?: 0)?(?: only| or later)?", "gnu general public license(?: version| v) ?3"]),
    ("gpl", ["gpl", "gnu general public"]),
    ("lgpl-2.1", ["lgplv2 1", "lgpl(?: version)? v?2 1", "gnu lesser general public license(?: version| v) ?2 1"]),
    ("lgpl-3.0", ["lgplv3", "lgpl(?: version)? v?3(?: 0)?", "gnu lesser general public license(?: version| v) ?3"]),
    ("lgpl", ["lgpl", "gnu lesser general public", "gnu library general public"]),
    ("agpl-3.0", ["agplv3", "agpl(?: version)? v?3(?: 0)?", "gnu affero general public license(?: version| v) ?3"]),
    ("agpl", ["agpl", "gnu affero general public"]),
    ("gfdl", ["gfdl", "gnu free documentation"]),
    ("mpl-1.1", ["mpl 1 1", "mozilla public license(?: version)? 1 1"]),
    ("mpl-2.0", ["mpl 2 0", "mozilla public license(?: version| v)? ?2(?: 0)?"]),
    ("mpl", ["mpl", "mozilla public"]),
    ("epl-1.0", ["epl 1 0", "eclipse public license(?: version| v)? ?1 0"]),
    ("epl-2.0", ["epl 2 0", "eclipse public license(?: version| v)? ?2(?: 0)?"]),
    ("epl", ["epl", "eclipse public"]),
    ("cddl", ["cddl(?: 1 [01])?", "common development and distribution"]),
    ("cpl-1.0", ["cpl 1 0", "common public license(?: version)? 1 0"]),
    ("artistic-2.0", ["artistic 2 0", "artistic license 2 0"]),
    ("artistic", ["artistic"]),
    ("bsl-1.0", ["bsl 1 0", "boost software"]),
    ("busl-1.1", ["busl 1 1", "business source"]),
    ("eupl", ["eupl(?: 1 [0-2])?", "european union public"]),
    ("wtfpl", ["wtfpl", "do what the fuck you want to public"]),
    ("unlicense", ["unlicense"]),
    ("zlib", ["zlib", "zlib libpng"]),
    ("libpng", ["libpng"]),
    ("openssl", ["openssl"]),
    ("python-2.0", ["python software foundation", "psf"]),
    ("ruby", ["ruby"]),
    ("php", ["php"]),
    ("postgresql", ["postgresql"]),
    ("perl", ["same terms as perl itself"]),
    ("sil-ofl", ["ofl(?: 1 1)?", "sil open font", "open font"]),
    ("ms-pl", ["ms pl", "microsoft public"]),
    ("ms-rl", ["ms rl", "microsoft reciprocal"]),
    ("sspl", ["sspl(?: 1 0)?", "server side public"]),
    ("elastic", ["elastic"]),
    ("odbl", ["odbl(?: 1 0)?", "open database"]),
    ("odc-by", ["odc by", "open data commons attribution"]),
    ("pddl", ["pddl", "public domain dedication and"]),
    ("openrail", ["openrail(?: m)?", "responsible ai"]),
    ("cc0", ["cc0(?: 1 0)?", "creative commons zero"]),
    ("cc-by", ["cc by(?: [1-4] 0)?", "creative commons attribution(?: [1-4] 0)?"]),
    ("cc-by-sa", ["cc by sa(?: [1-4] 0)?", "creative commons attribution share ?alike(?: [1-4] 0)?"]),
    ("cc-by-nd", ["cc by nd(?: [1-4] 0)?", "creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] 0)?"]),
    ("cc-by-nc", ["cc by nc(?: [1-4] 0)?", "creative commons attribution non ?commercial(?: [1-4] 0)?"]),
    ("cc-by-nc-sa", ["cc by nc sa(?: [1-4] 0)?", "creative commons attribution non ?commercial share ?alike(?: [1-4] 0)?"]),
    ("cc-by-nc-nd", ["cc by nc nd(?: [1-4] 0)?", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1-4] 0)?"]),
]
#: names that alone say a license is meant; other names need a form around them
SPEAKING = frozenset(
    "gpl-2.0 gpl-3.0 lgpl-2.1 lgpl-3.0 agpl-3.0 mpl-2.0 mpl-1.1 epl-1.0 epl-2.0 cc0 cc-by cc-by-sa cc-by-nd cc-by-nc cc-by-nc-sa "
    "cc-by-nc-nd apache-2 bsd-2-clause bsd-3-clause bsd-4-clause gfdl wtfpl sspl odbl sil-ofl".split())

#: priority of an exact name by itself: above a form around a general name, below other forms
EXACT = 55
#: names that are words of their own; a list does not make licenses of them
COMMON = frozenset("ruby php postgresql openssl elastic artistic perl python-2.0 x11 libpng zlib".split())
LOOSE = r"licen[sc]e(?:d| is| type)? {name}"
MIT_MEANT = re.compile(r"(?i:licen[sc]e)(?i:d|\s+is|\s+type)?\W+(?:MIT\b|[Mm]it(?:\s*[^\w\s]|\s*$|\s*\n))")
# Forms of a signature: pattern around a name, priority, confidence.
FORMS = [
    (r"spdx license identifier {name}", 90, 1.0),
    (r"(?:licen[sc]ed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?(?:conditions of )?"
     r"(?:the )?{name}(?: licen[sc]e)?(?: version [0-9]+(?: [0-9]+)?)?", 80, 0.95),
    (r"(?:under|subject to) (?:the )?(?:terms of )?(?:the )?{name} licen[sc]e(?: version [0-9]+(?: [0-9]+)?)?", 75, 0.9),
    (LOOSE, 60, 0.8),
    (r"{name} licen[sc]e(?:d| version [0-9]+(?: [0-9]+)?)?", 50, 0.7),
]

# Signatures without a name: pattern, label, priority, confidence, keywords.
TEXTS = [
    (r"permission is hereby granted free of charge to any person obtaining a copy", "mit", 85, 1.0, ["hereby"]),
    (r"permission to use copy modify and or distribute this software for any purpose", "isc", 85, 1.0, ["permission"]),
    (r"redistribution and use in source and binary forms with or without modification", "bsd", 85, 1.0, ["redistribution"]),
    (r"neither the name of .{1,80} nor the names of its contributors", "bsd-3-clause", 85, 1.0, ["neither"]),
    (r"this is free and unencumbered software released into the public domain", "unlicense", 85, 1.0, ["unencumbered"]),
    (r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
     "gpl", 85, 1.0, ["gnu"]),
    (r"www apache org licenses license 2 0", "apache-2", 85, 1.0, ["apache"]),
    (r"opensource org licenses mit(?: license php)?", "mit", 85, 0.95, ["opensource"]),
    (r"creativecommons org publicdomain zero 1 0", "cc0", 85, 1.0, ["creativecommons"]),
    (r"gnu org licenses gpl(?: [23] 0)?", "gpl", 70, 0.9, ["gnu"]),
    (r"mozilla org mpl 2 0", "mpl-2.0", 85, 0.95, ["mozilla"]),
    (r"all rights reserved", "all-rights-reserved", 20, 0.3, ["reserved"]),
    (r"(?:released|dedicated|placed|is) (?:in|to|into) the public domain", "public-domain", 60, 0.8, ["domain"]),
] + [
    (rf"creativecommons org licenses {code.replace('-', ' ')}(?: [1-4] 0)?", f"cc-{code}", 85, 1.0, ["creativecommons"])
    for code in ["by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"]
]

# Signatures of license texts, notices and headers: pattern, label, priority, confidence, keywords.
SIGNATURES = [
    # mit and relatives
    (r"to deal in the software without restriction including without limitation the rights", "mit", 84, 0.95, ["without restriction"]),
    (r"the above copyright notice and this permission notice shall be included in all copies or substantial portions", "mit", 84, 0.95, ["substantial portions"]),
    (r"the above copyright notice and this permission notice including the next paragraph shall be included", "x11", 86, 0.95, ["next paragraph"]),
    (r"except as contained in this notice the name of the x consortium shall not be used in advertising", "x11", 86, 1.0, ["consortium"]),
    (r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability",
     "mit", 70, 0.8, ["merchantability"]),
    (r"permission is hereby granted without written agreement and without license or royalty fees to use copy modify and distribute", "mit", 83, 0.9, ["without royalty", "royalty fees"]),
    (r"https? (?:www )?opensource org licen[sc]es mit licen[sc]e", "mit", 86, 1.0, ["opensource"]),
    (r"choosealicense com licenses mit", "mit", 85, 0.95, ["choosealicense"]),
    (r"spdx org licenses mit(?: html)?", "mit", 85, 0.95, ["spdx"]),
    (r"see (?:the )?licen[sc]e (?:file )?for mit licen[sc]e details", "mit", 70, 0.8, ["mit licen"]),
    # isc, zlib, boost, fair terms
    (r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc", 86, 1.0, ["or without fee"]),
    (r"the software is provided as is and the author disclaims all warranties with regard to this software", "isc", 80, 0.85, ["disclaims"]),
    (r"in no event shall the author be liable for any special direct indirect or consequential damages", "isc", 70, 0.6, ["consequential"]),
    (r"opensource org licenses isc(?: license)?", "isc", 85, 0.95, ["opensource"]),
    (r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "zlib", 85, 1.0, ["the authors be"]),
    (r"the origin of this software must not be misrepresented you must not claim that you wrote the original software", "zlib", 86, 1.0, ["misrepresented"]),
    (r"altered source versions must be plainly marked as such", "zlib", 84, 0.95, ["altered"]),
    (r"boost org license 1 0 txt", "bsl-1.0", 86, 1.0, ["boost"]),
    (r"distributed under the boost software license version 1 0", "bsl-1.0", 88, 1.0, ["boost"]),
    (r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation",
     "bsl-1.0", 87, 1.0, ["person or organization"]),
    (r"copying and distribution of this file with or without modification are permitted in any medium without royalty", "fsfap", 85, 1.0, ["without royalty", "royalty fees"]),
    (r"permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted",
     "hpnd", 85, 0.95, ["documentation"]),
    (r"you can do whatever you want with this stuff if we meet some day and you think this stuff is worth it you can buy me a beer", "beerware", 86, 1.0, ["me a beer"]),
    (r"the beer ?ware licen[sc]e", "beerware", 86, 1.0, ["beerware", "beer"]),
    (r"the software shall be used for good not evil", "json", 86, 1.0, ["not evil"]),
    # bsd family
    (r"redistributions of source code must retain the above copyright notice", "bsd", 84, 0.95, ["redistributions"]),
    (r"redistributions in binary form must reproduce the above copyright notice", "bsd", 84, 0.95, ["redistributions"]),
    (r"neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products", "bsd-3-clause", 86, 1.0, ["endorse"]),
    (r"neither the name of the university nor the names of its contributors may be used to endorse", "bsd-3-clause", 86, 1.0, ["name of the university"]),
    (r"the name of the author may not be used to endorse or promote products derived from this software", "bsd-3-clause", 86, 0.95, ["endorse"]),
    (r"all advertising materials mentioning features or use of this software must display the following acknowledg?e?ment", "bsd-4-clause", 87, 1.0, ["advertising materials"]),
    (r"this product includes software developed by the university of california berkeley and its contributors", "bsd-4-clause", 87, 1.0, ["berkeley"]),
    (r"the views and conclusions contained in the software and documentation are those of the authors", "bsd-2-clause", 84, 0.9, ["conclusions"]),
    (r"this software is provided by the copyright holders and contributors as is and any express or implied warranties", "bsd", 80, 0.85, ["contributors"]),
    (r"use of this source code is governed by a bsd style licen[sc]e", "bsd", 88, 1.0, ["governed"]),
    (r"governed by an mit style licen[sc]e", "mit", 88, 1.0, ["governed"]),
    (r"opensource org licenses bsd 2 clause", "bsd-2-clause", 86, 0.95, ["opensource"]),
    (r"opensource org licenses bsd 3 clause", "bsd-3-clause", 86, 0.95, ["opensource"]),
    (r"opensource org licenses bsd license(?: php)?", "bsd", 85, 0.95, ["opensource"]),
    (r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is",
     "0bsd", 87, 0.95, ["or without fee"]),
    # apache
    (r"licensed under the apache license version 2 0 the license", "apache-2", 90, 1.0, ["apache"]),
    (r"you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2", 82, 0.8, ["in compliance with"]),
    (r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
     "apache-2", 86, 0.95, ["applicable law"]),
    (r"apache license version 2 0 january 2004", "apache-2", 90, 1.0, ["january 2004"]),
    (r"terms and conditions for use reproduction and distribution 1 definitions license shall mean the terms", "apache-2", 86, 1.0, ["use reproduction"]),
    (r"grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce", "apache-2", 86, 0.95, ["irrevocable"]),
    (r"grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable except as stated in this section patent license",
     "apache-2", 86, 0.95, ["patent license"]),
    (r"this product includes software developed by the apache software foundation", "apache-1.1", 84, 0.8, ["apache software foundation"]),
    (r"licensed to the apache software foundation asf under one or more contributor license agreements", "apache-2", 88, 1.0, ["asf"]),
    (r"opensource org licenses apache 2 0", "apache-2", 86, 0.95, ["opensource"]),
    (r"the names apache server and apache group must not be used to endorse", "apache-1.0", 86, 1.0, ["endorse"]),
    # gnu
    (r"either version 2 of the license or at your option any later version", "gpl-2.0", 72, 0.8, ["your option"]),
    (r"either version 3 of the license or at your option any later version", "gpl-3.0", 72, 0.8, ["your option"]),
    (r"under the terms of the gnu general public license as published by the free software foundation either version 2 of the license",
     "gpl-2.0", 89, 1.0, ["as published by"]),
    (r"under the terms of the gnu general public license as published by the free software foundation either version 3 of the license",
     "gpl-3.0", 89, 1.0, ["as published by"]),
    (r"under the terms of the gnu general public license version 2 (?:only )?as published by the free software foundation", "gpl-2.0", 89, 1.0, ["as published by"]),
    (r"under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license",
     "lgpl-2.1", 90, 1.0, ["as published by"]),
    (r"under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license",
     "lgpl-3.0", 90, 1.0, ["as published by"]),
    (r"under the terms of the gnu library general public license as published by the free software foundation", "lgpl-2.0", 90, 1.0, ["gnu library"]),
    (r"under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license",
     "agpl-3.0", 90, 1.0, ["affero"]),
    (r"gnu general public license version 2 june 1991", "gpl-2.0", 91, 1.0, ["june 1991", "29 june"]),
    (r"gnu general public license version 3 29 june 2007", "gpl-3.0", 91, 1.0, ["june 1991", "29 june"]),
    (r"gnu lesser general public license version 2 1 february 1999", "lgpl-2.1", 91, 1.0, ["february 1999"]),
    (r"gnu lesser general public license version 3 29 june 2007", "lgpl-3.0", 91, 1.0, ["june 1991", "29 june"]),
    (r"gnu affero general public license version 3 19 november 2007", "agpl-3.0", 91, 1.0, ["november 2007"]),
    (r"gnu free documentation license version 1 [1-3]", "gfdl", 88, 1.0, ["documentation"]),
    (r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "gfdl", 90, 1.0, ["this document under"]),
    (r"with no invariant sections no front cover texts and no back cover texts", "gfdl", 86, 1.0, ["invariant"]),
    (r"the gnu general public license is a free copyleft license for software and other kinds of works", "gpl-3.0", 88, 1.0, ["copyleft"]),
    (r"the licenses for most software are designed to take away your freedom to share and change it", "gpl-2.0", 84, 0.9, ["your freedom"]),
    (r"you should have received a copy of the gnu general public license along with this (?:program|software|package|library|file)", "gpl", 82, 0.95, ["have received a copy"]),
    (r"you should have received a copy of the gnu lesser general public license along with this", "lgpl", 83, 0.95, ["have received a copy"]),
    (r"you should have received a copy of the gnu affero general public license along with this", "agpl", 83, 0.95, ["have received a copy"]),
    (r"gnu org licenses old licenses gpl 2 0(?: html| txt)?", "gpl-2.0", 86, 0.95, ["gnu"]),
    (r"gnu org licenses gpl 3 0(?: html| txt)?", "gpl-3.0", 86, 0.95, ["gnu"]),
    (r"gnu org licenses old licenses lgpl 2 1(?: html| txt)?", "lgpl-2.1", 86, 0.95, ["gnu"]),
    (r"gnu org licenses lgpl 3 0(?: html| txt)?", "lgpl-3.0", 86, 0.95, ["gnu"]),
    (r"gnu org licenses lgpl(?: html| txt)?", "lgpl", 70, 0.9, ["gnu"]),
    (r"gnu org licenses agpl(?: 3 0)?(?: html| txt)?", "agpl-3.0", 86, 0.95, ["gnu"]),
    (r"gnu org licenses fdl(?: 1 [1-3])?(?: html| txt)?", "gfdl", 86, 0.95, ["gnu"]),
    (r"51 franklin street fifth floor boston ma 02110 1301", "gpl", 60, 0.6, ["franklin"]),
    (r"59 temple place suite 330 boston ma 02111 1307", "gpl", 60, 0.6, ["temple"]),
    (r"with the special exception to link the code of portions of this program with the openssl library", "gpl-openssl-exception", 86, 0.95, ["special exception"]),
    (r"under gpl v?2 or (?:any )?later(?: version)?", "gpl-2.0", 78, 0.9, ["gpl"]),
    (r"under gpl v?3 or (?:any )?later(?: version)?", "gpl-3.0", 78, 0.9, ["gpl"]),
    (r"gnu gpl(?: v| version)? ?2(?: 0)?", "gpl-2.0", 58, 0.8, ["gnu"]),
    (r"gnu gpl(?: v| version)? ?3(?: 0)?", "gpl-3.0", 58, 0.8, ["gnu"]),
    (r"gnu lgpl(?: v| version)? ?2 1", "lgpl-2.1", 58, 0.8, ["gnu"]),
    (r"gnu lgpl(?: v| version)? ?3(?: 0)?", "lgpl-3.0", 58, 0.8, ["gnu"]),
    (r"gnu agpl(?: v| version)? ?3(?: 0)?", "agpl-3.0", 58, 0.8, ["gnu"]),
    # mozilla, eclipse, sun, ibm
    (r"this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0", 91, 1.0, ["mozilla"]),
    (r"if a copy of the mpl was not distributed with this file you can obtain one at", "mpl-2.0", 88, 1.0, ["obtain one at"]),
    (r"this source code form is incompatible with secondary licenses", "mpl-2.0-no-copyleft-exception", 88, 1.0, ["incompatible"]),
    (r"the contents of this file are subject to the mozilla public license version 1 1", "mpl-1.1", 91, 1.0, ["mozilla"]),
    (r"the contents of this file are subject to the mozilla public license version 1 0", "mpl-1.0", 91, 1.0, ["mozilla"]),
    (r"alternatively the contents of this file may be used under the terms of either the gnu general public license", "gpl-2.0", 84, 0.8, ["alternatively the contents"]),
    (r"mozilla org (?:en us )?mpl 1 1", "mpl-1.1", 86, 0.95, ["mozilla"]),
    (r"netscape public license(?: version)? 1 [01]", "npl", 86, 0.95, ["netscape"]),
    (r"this program and the accompanying materials are made available under the terms of the eclipse public license v 1 0", "epl-1.0", 91, 1.0, ["eclipse"]),
    (r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v |version )?2 0", "epl-2.0", 91, 1.0, ["eclipse"]),
    (r"eclipse org legal epl v10(?: html)?", "epl-1.0", 86, 0.95, ["eclipse"]),
    (r"eclipse org legal epl (?:v20|2 0)(?: html)?", "epl-2.0", 86, 0.95, ["eclipse"]),
    (r"eclipse distribution license v? ?1 0", "bsd-3-clause", 84, 0.9, ["eclipse"]),
    (r"the contents of this file are subject to the terms of the common development and distribution license", "cddl", 90, 1.0, ["common development"]),
    (r"you can obtain a copy of the license at usr src opensolaris license or", "cddl", 86, 1.0, ["opensolaris"]),
    (r"common development and distribution license cddl version 1 0", "cddl", 89, 1.0, ["common development"]),
    (r"ibm public license version 1 0", "ipl-1.0", 86, 1.0, ["ibm"]),
    (r"apple public source license(?: version)? ?(?:1 [0-2]|2 0)", "apsl", 86, 1.0, ["apple public"]),
    (r"sun industry standards source license", "sissl", 86, 1.0, ["sun industry"]),
    (r"common public attribution license(?: version)? ?(?:1 0)?", "cpal-1.0", 86, 1.0, ["public attribution"]),
    (r"open software license(?: version| v)? ?3 0", "osl-3.0", 86, 1.0, ["open software license"]),
    (r"academic free license(?: version| v)? ?(?:1 [12]|2 [01]|3 0)", "afl", 86, 1.0, ["academic free"]),
    (r"q public license(?: version)? ?(?:1 0)?", "qpl", 84, 0.95, ["q public"]),
    (r"lucent public license(?: version)? ?(?:1 0[02]?|1 02)?", "lpl", 84, 0.95, ["lucent"]),
    (r"licen[cs]ed under the eupl(?: version)? ?(?:1 [0-2])?", "eupl", 90, 1.0, ["eupl"]),
    (r"european union public licen[cs]e v ?1 [0-2]", "eupl", 88, 1.0, ["european union"]),
    (r"cecill(?: b| c)?(?: free software)? licen[cs]e(?: agreement)?", "cecill", 84, 0.95, ["cecill"]),
    (r"mulan psl v2|mulan permissive software licen[sc]e version 2", "mulanpsl-2.0", 86, 1.0, ["mulan"]),
    (r"licensed under the universal permissive license v 1 0", "upl-1.0", 88, 1.0, ["universal permissive"]),
    (r"blue oak model license(?: 1 0 0)?", "blueoak-1.0.0", 86, 1.0, ["blue oak"]),
    # public domain and dedications
    (r"anyone is free to copy modify publish use compile sell or distribute this software", "unlicense", 88, 1.0, ["anyone is free"]),
    (r"for more information please refer to https? (?:www )?unlicense org", "unlicense", 86, 1.0, ["unlicense"]),
    (r"to the extent possible under law .{1,80} has waived all copyright and related or neighboring rights", "cc0", 88, 1.0, ["waived"]),
    (r"the person who associated a work with this deed has dedicated the work to the public domain", "cc0", 88, 1.0, ["deed"]),
    (r"the author disclaims copyright to this source code in place of a legal notice here is a blessing", "blessing", 88, 1.0, ["blessing"]),
    (r"may you do good and not evil may you find forgiveness for yourself and forgive others", "blessing", 88, 1.0, ["forgiveness"]),
    (r"this (?:file|work|code|software|program) has been (?:put|placed|released) in(?:to)? the public domain", "public-domain", 75, 0.9, ["public domain"]),
    (r"public domain mark 1 0", "pdm-1.0", 85, 0.95, ["domain mark"]),
    (r"no rights reserved", "cc0", 55, 0.5, ["rights reserved"]),
    (r"do what the fuck you want to public license version 2 december 2004", "wtfpl", 91, 1.0, ["december 2004"]),
    (r"you just do what the fuck you want to", "wtfpl", 86, 1.0, ["fuck"]),
    # creative commons and content
    (r"this work is licensed under a creative commons attribution [1-4] 0 (?:international|unported) license", "cc-by", 91, 1.0, ["creative"]),
    (r"this work is licensed under (?:a|the) creative commons attribution share ?alike [1-4] 0 (?:international|unported) license", "cc-by-sa", 91, 1.0, ["creative"]),
    (r"this work is licensed under (?:a|the) creative commons attribution non ?commercial [1-4] 0 (?:international|unported) license", "cc-by-nc", 91, 1.0, ["creative"]),
    (r"this work is licensed under (?:a|the) creative commons attribution no ?derivatives [1-4] 0 (?:international|unported) license", "cc-by-nd", 91, 1.0, ["creative"]),
    (r"this work is licensed under (?:a|the) creative commons attribution non ?commercial share ?alike [1-4] 0 (?:international|unported) license",
     "cc-by-nc-sa", 91, 1.0, ["creative"]),
    (r"this work is licensed under (?:a|the) creative commons attribution non ?commercial no ?derivatives [1-4] 0 (?:international|unported) license",
     "cc-by-nc-nd", 91, 1.0, ["creative"]),
    (r"text is available under the creative commons attribution share ?alike licen[sc]e", "cc-by-sa", 91, 1.0, ["creative"]),
    (r"you are free to share copy and redistribute the material in any medium or format", "cc", 70, 0.7, ["redistribute"]),
    (r"some rights reserved", "cc", 40, 0.4, ["rights reserved"]),
    (r"open government licen[sc]e(?: v(?:ersion)? ?[1-3] 0| v[1-3] 0)?", "ogl", 84, 0.95, ["open government"]),
    (r"contains public sector information licensed under the open government licence", "ogl", 89, 1.0, ["public sector"]),
    (r"datenlizenz deutschland (?:namensnennung|zero)(?: version 2 0)?", "dl-de", 86, 1.0, ["datenlizenz"]),
    (r"licen[cs]e ouverte(?: open licen[cs]e)?(?: version)? ?(?:[12] 0)?", "etalab", 84, 0.95, ["ouverte"]),
    (r"community data license agreement (?:permissive|sharing)(?: version)? ?(?:[12] 0)?", "cdla", 86, 1.0, ["community data"]),
    (r"this .{1,40} is made available under the open database license", "odbl", 90, 1.0, ["open database"]),
    (r"opendatacommons org licenses odbl", "odbl", 86, 0.95, ["opendatacommons"]),
    (r"opendatacommons org licenses by", "odc-by", 86, 0.95, ["opendatacommons"]),
    (r"opendatacommons org licenses pddl", "pddl", 86, 0.95, ["opendatacommons"]),
    (r"free art licen[sc]e(?: 1 [23])?", "fal", 84, 0.95, ["free art"]),
    (r"this font software is licensed under the sil open font license version 1 1", "sil-ofl", 91, 1.0, ["font software"]),
    (r"the fonts and derivatives however cannot be released under any other type of license", "sil-ofl", 86, 1.0, ["the fonts and"]),
    (r"scripts sil org ofl", "sil-ofl", 86, 0.95, ["sil"]),
    (r"ubuntu font licence version 1 0", "ufl", 86, 1.0, ["ubuntu"]),
    (r"bitstream vera fonts copyright", "bitstream-vera", 84, 0.95, ["bitstream"]),
    # languages, databases, tools
    (r"psf license agreement for python [0-9]", "python-2.0", 88, 1.0, ["psf"]),
    (r"python software foundation license version 2", "python-2.0", 88, 1.0, ["python"]),
    (r"you may redistribute it and or modify it under either the terms of the 2 clause bsdl", "ruby", 86, 1.0, ["bsdl"]),
    (r"you can redistribute it and or modify it under the same terms as perl itself", "perl", 86, 1.0, ["perl"]),
    (r"under the terms of either the gnu general public license or the artistic license", "perl", 86, 1.0, ["artistic"]),
    (r"the artistic license 2 0 copyright c 2000 2006 the perl foundation", "artistic-2.0", 90, 1.0, ["artistic"]),
    (r"this source file is subject to version 3 0[0-9]? of the php license", "php", 90, 1.0, ["php"]),
    (r"php net license 3 0[0-9]? txt", "php", 86, 0.95, ["php"]),
    (r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement",
     "postgresql", 87, 1.0, ["written agreement"]),
    (r"this product includes software developed by the openssl project for use in the openssl toolkit", "openssl", 88, 1.0, ["openssl toolkit"]),
    (r"this product includes cryptographic software written by eric young", "openssl", 87, 1.0, ["cryptographic"]),
    (r"this code is released under the libpng license", "libpng", 86, 1.0, ["libpng"]),
    (r"this software is based in part on the work of the independent jpeg group", "ijg", 86, 1.0, ["jpeg"]),
    (r"copyright c 1996 .{0,12}daniel stenberg", "curl", 80, 0.9, ["stenberg"]),
    (r"unicode license agreement data files and software", "unicode", 86, 1.0, ["unicode"]),
    (r"icu license icu 1 8 1 and later", "icu", 86, 1.0, ["icu"]),
    (r"w3c software notice and license", "w3c", 86, 1.0, ["w3c"]),
    (r"university of illinois ncsa open source license", "ncsa", 88, 1.0, ["illinois"]),
    (r"latex project public license(?: version)? ?(?:1 [0-3]c?)?", "lppl", 86, 1.0, ["latex"]),
    (r"sleepycat license|redistributions in any form must be accompanied by information on how to obtain complete source code", "sleepycat", 86, 0.95,
     ["sleepycat", "redistributions"]),
    (r"vim license|vim is charityware", "vim", 84, 0.95, ["vim license", "vim is"]),
    (r"info zip license|info zip copyright and license", "info-zip", 84, 0.95, ["info zip"]),
    (r"microsoft public license ms pl", "ms-pl", 88, 1.0, ["microsoft"]),
    (r"microsoft reciprocal license ms rl", "ms-rl", 88, 1.0, ["microsoft"]),
    # restricted terms
    (r"server side public license version 1 october 16 2018", "sspl", 91, 1.0, ["october 16"]),
    (r"licensed under the elastic license 2 0", "elastic", 91, 1.0, ["elastic"]),
    (r"you may not provide the software to third parties as a hosted or managed service", "elastic", 86, 1.0, ["hosted or managed"]),
    (r"business source license 1 1 parameters licensor", "busl-1.1", 91, 1.0, ["parameters licensor"]),
    (r"change date .{1,40} change license", "busl-1.1", 80, 0.8, ["change license"]),
    (r"commons clause license condition v1 0", "commons-clause", 88, 1.0, ["commons clause"]),
    (r"the license does not grant to you the right to sell the software", "commons-clause", 86, 1.0, ["right to sell"]),
    (r"confluent community license(?: agreement)?(?: version)? ?(?:1 0)?", "confluent", 86, 1.0, ["confluent"]),
    (r"redis source available license", "rsal", 86, 1.0, ["redis source"]),
    (r"polyform (?:noncommercial|small business|perimeter|shield|strict|internal use|free trial) license", "polyform", 86, 1.0, ["polyform"]),
    (r"prosperity public license", "prosperity", 84, 0.95, ["prosperity"]),
    (r"functional source license(?: version)? ?(?:1 [01])?", "fsl", 84, 0.95, ["functional source"]),
    (r"bigscience (?:open ?rail ?m|rail) license(?: v1 0)?", "openrail", 86, 1.0, ["bigscience"]),
    (r"creativeml open ?rail ?m", "openrail", 86, 1.0, ["creativeml"]),
    (r"use restrictions as set forth in attachment a", "openrail", 80, 0.85, ["attachment"]),
    (r"hippocratic license(?: version)? ?(?:[12] [0-2]|3 0)?", "hippocratic", 86, 1.0, ["hippocratic"]),
    (r"end user licen[sc]e agreement", "eula", 60, 0.8, ["end user"]),
    (r"this software is (?:the )?(?:confidential and )?proprietary (?:information|to|and confidential)", "proprietary", 70, 0.8, ["proprietary"]),
    (r"unauthori[sz]ed copying of this (?:file|software|work) via any medium is strictly prohibited", "proprietary", 84, 0.95, ["strictly prohibited"]),
    (r"for (?:personal|evaluation|academic|research) (?:and (?:personal|evaluation|academic|research) )?use only", "restricted-use", 55, 0.6, ["use only"]),
    (r"not for commercial use|no commercial use|non commercial use only", "non-commercial", 55, 0.6, ["commercial use"]),
]


class Rule:
    """One signature. ``keywords``: words of which every match has one."""

    def __init__(self, pattern: str, label: str, priority: int, confidence: float, keywords: list[str]):
        self.label, self.priority, self.confidence = label, priority, confidence
        self.keywords = [k.encode() for k in keywords]
        #: what the text as it is must hold as well
        self.confirm: re.Pattern | None = None
        #: made of a name and a form
        self.named = False
        self.find = re.compile(f"(?<= )(?:{pattern})(?= )".encode()).finditer


def _keyword(name: str) -> str:
    """The first plain word of a name; every match of the name has it, as a word or as the start of one."""
    return re.match(r"[0-9a-z]+", name)[0]


def rules() -> list[Rule]:
    """All rules, by priority."""
    out = [Rule(phrase, label, 100, 1.0, [phrase.split()[-1 if label == "mit" else 0]]) for phrase, label in BASE_PHRASES.items()]
    for label, names in LICENSES:
        for name in names:
            for form, priority, confidence in FORMS:
                # a longer name says more: with equal forms, "apache 2 0" before "apache"
                rule = Rule(form.format(name=f"(?:{name})"), label, priority, confidence, [_keyword(name)])
                if name == "mit" and form == LOOSE:
                    rule.confirm = MIT_MEANT
                rule.named = True
                out.append(rule)
            if label in SPEAKING:
                out.append(Rule(name, label, EXACT, 0.6, [_keyword(name)]))
                out[-1].named = True
    out += [Rule(*t) for t in TEXTS + SIGNATURES]
    return sorted(out, key=lambda r: -r.priority)


_WORDS = bytes(c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() and c < 0x80 else 32 for c in range(256))
#: no rule made of a name and a form matches a text without one of these
GATE = tuple(x.encode() for x in (
    "licen", "gpl", "spdx", "cc by", "cc0", "public domain", "creative", "permission", "redistribut", "reserved", "apache", "mozilla",
    "released under", "distributed under", "available under", "published under", "provided under", "subject to", "gnu", "wtfpl",
    "what the fuck", " mpl", " epl", "eclipse public", "bsd", "gfdl", "sspl", "server side public", "odbl", "open database", " ofl",
    "open font", "unencumbered", "neither the name", "opensource"))
#: words in front of a detection that turn it into its contrary
NEGATED = re.compile(rb"(?:^| )(?:not|never|no longer|isn t|aren t|neither)(?: (?!only )[a-z]+)? \Z")
LIST_REACH = 90


class Detection:
    __slots__ = ("start", "end", "rule")

    def __init__(self, start: int, end: int, rule: Rule):
        self.start, self.end, self.rule = start, end, rule


def resolve(found: list[Detection]) -> list[Detection]:
    """Detections that no other one contains with a higher priority, or with the same one and a longer interval. Base phrases
    (the highest priority) always stay. One sweep: whatever contains a detection comes before it, so the furthest end so far
    of each priority decides."""
    kept = []
    reach: dict[int, int] = {}
    for d in sorted(found, key=lambda d: (d.start, -d.end, -d.rule.priority)):
        p = d.rule.priority
        if p == 100 or not any(end >= d.end for q, end in reach.items() if q >= p):
            kept.append(d)
        reach[p] = max(reach.get(p, -1), d.end)
    return kept


class Scanner:
    def __init__(self):
        from ahocorasick import Automaton

        self.rules = rules()
        self.base = [(f" {p} ".encode(), label) for p, label in BASE_PHRASES.items()]
        # gates and keywords are found in one pass over a text: index of each, whether it is a gate, the rules that it is a keyword of
        self.marks: dict[str, int] = {}
        self.gates: set[int] = set()
        self.by_mark: dict[int, list[Rule]] = {}
        for g in GATE:
            self.gates.add(self.marks.setdefault(g.decode(), len(self.marks)))
        for rule in self.rules:
            for k in rule.keywords:
                self.by_mark.setdefault(self.marks.setdefault(" " + k.decode(), len(self.marks)), []).append(rule)
        self.finder = Automaton()
        for mark, index in self.marks.items():
            self.finder.add_word(mark, index)
        self.finder.make_automaton()
        # names of a list, the longer first; one group each
        self.names = sorted(((n, label) for label, names in LICENSES if label not in COMMON for n in names), key=lambda x: -len(x[0]))
        any_name = "|".join(f"({n})" for n, _ in self.names)
        self.after = re.compile(rf" (?:and|or|and or) (?:the )?(?:{any_name})(?: licen[sc]e)?(?= )".encode())
        self.before = re.compile(rf"(?<= )(?:{any_name}) (?:and|or|and or) (?:the )?\Z".encode())
        self.listed = [Rule(n, label, 60, 0.7, []) for n, label in self.names]

    def detections(self, line: bytes, text: str, rules: list[Rule]) -> list[Detection]:
        """What the rules find, with the lists around it, without what is negated."""
        found = [Detection(m.start(), m.end(), r) for r in rules for m in r.find(line) if not r.confirm or r.confirm.search(text)]
        more, seen = [], {(d.start, d.end) for d in found}
        for d in found:
            if d.rule.priority < EXACT:
                continue
            at = d.end
            while m := self.after.match(line, at):
                at = m.end()
                if (m.start(m.lastindex), at) not in seen:
                    seen.add((m.start(m.lastindex), at))
                    more.append(Detection(m.start(m.lastindex), at, self.listed[m.lastindex - 1]))
            at = d.start
            while m := self.before.search(line, max(0, at - LIST_REACH), at):
                at = m.start()
                if (at, m.end(m.lastindex)) not in seen:
                    seen.add((at, m.end(m.lastindex)))
                    more.append(Detection(at, m.end(m.lastindex), self.listed[m.lastindex - 1]))
        denied = [(d.start, d.end) for d in found + more if NEGATED.search(line, max(0, d.start - 30), d.start)]
        return [d for d in found + more if d.rule.priority == 100 or not any(a <= d.start and d.end <= b for a, b in denied)]

    def candidates(self, line: bytes) -> list[Rule]:
        """The rules whose keywords are there, in order; those made of a name and a form need a gate as well."""
        hits = {index for _, index in self.finder.iter(line.decode("latin-1"))}
        gated = not hits.isdisjoint(self.gates)
        present = {id(r) for i in hits for r in self.by_mark.get(i, ()) if gated or not r.named}
        return [r for r in self.rules if id(r) in present] if present else []

    def words(self, text: str) -> tuple[list[bytes], bytes]:
        words = text.encode("utf-8", "replace").translate(_WORDS).split()
        return words, b" " + b" ".join(words) + b" "

    def scan(self, text: str) -> tuple:
        words, line = self.words(text)
        candidates = self.candidates(line)
        if not candidates:
            return len(words), 0, None, None, [], [], 0.0
        starts, base = [], set()
        for phrase, label in self.base:
            at = line.find(phrase)
            while at >= 0:
                starts.append(at)
                base.add(label)
                at = line.find(phrase, at + 1)
        kept = resolve(self.detections(line, text, candidates))
        labels = sorted({d.rule.label for d in kept} | base)
        first = line.count(b" ", 0, min(starts)) if starts else None
        last = line.count(b" ", 0, max(starts)) if starts else None
        score = max([d.rule.confidence for d in kept] + [1.0] * bool(base), default=0.0)
        return len(words), len(starts), first, last, sorted(base), labels, score


SCAN = T.StructType([
    T.StructField("n_words", T.LongType(), False), T.StructField("n_base", T.LongType(), False),
    T.StructField("first_word", T.LongType(), True), T.StructField("last_word", T.LongType(), True),
    T.StructField("base_labels", T.ArrayType(T.StringType(), False), False),
    T.StructField("labels", T.ArrayType(T.StringType(), False), False), T.StructField("score", T.DoubleType(), False),
])


def scan(df: DataFrame, text: str = "text", into: str = "licenses", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with a struct: words, places of the base phrases, labels, and how sure the surest is."""

    def make():
        scanner = Scanner()

        def work(texts):
            rows = [scanner.scan(t) for t in texts]
            return [list(c) for c in zip(*rows)] if rows else [[] for _ in SCAN]

        return work

    return add_from_text(df, text, make, into, SCAN, keep)
