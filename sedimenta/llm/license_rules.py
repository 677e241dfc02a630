"""Ordered signature rules for licence texts: (label, priority, keyword, pattern).

Patterns are Java regular expressions, matched without regard to the case of A-Z. A single space in a pattern stands
for GAP, any run of characters that are neither letters nor digits; a pattern matches whole words only. The keyword is
a lower-case text that every match contains, from the beginning of a word; it gates the pattern. Priorities: 4 identifiers and exact grants, 3 names
with a version, 2 names and titles, 1 typical sentences and hints. Earlier rules win ties.
"""

from __future__ import annotations

Rule = tuple[str, int, str, str]
PRIORITIES = (4, 3, 2, 1)

#: SPDX identifiers and what their label is.
SPDX = """
0BSD AFL-1.1 AFL-1.2 AFL-2.0 AFL-2.1 AFL-3.0 AGPL-1.0 AGPL-3.0 Apache-1.0 Apache-1.1 Apache-2.0 APL-1.0 APSL-1.0 APSL-1.1
APSL-1.2 APSL-2.0 Artistic-1.0 Artistic-2.0 Beerware BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-3-Clause BSD-4-Clause
BSD-2-Clause-Patent BSD-3-Clause-Clear BSL-1.0 BUSL-1.1 CAL-1.0 CATOSL-1.1 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0
CC-BY-SA-1.0 CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-NC-1.0 CC-BY-NC-2.0 CC-BY-NC-2.5 CC-BY-NC-3.0 CC-BY-NC-4.0
CC-BY-ND-1.0 CC-BY-ND-2.0 CC-BY-ND-2.5 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-NC-SA-1.0 CC-BY-NC-SA-2.0 CC-BY-NC-SA-2.5 CC-BY-NC-SA-3.0
CC-BY-NC-SA-4.0 CC-BY-NC-ND-1.0 CC-BY-NC-ND-2.0 CC-BY-NC-ND-2.5 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1
CDLA-Permissive-1.0 CDLA-Permissive-2.0 CDLA-Sharing-1.0 CECILL-1.0 CECILL-1.1 CECILL-2.0 CECILL-2.1 CECILL-B CECILL-C CERN-OHL-1.2
CERN-OHL-P-2.0 CERN-OHL-S-2.0 CERN-OHL-W-2.0 CNRI-Python CPAL-1.0 CPL-1.0 CUA-OPL-1.0 ECL-1.0 ECL-2.0 EFL-1.0 EFL-2.0 Entessa
EPL-1.0 EPL-2.0 EUDatagrid EUPL-1.0 EUPL-1.1 EUPL-1.2 Fair FTL GFDL-1.1 GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-3.0 HPND ICU IJG
Intel IPA IPL-1.0 ISC JSON LAL-1.3 LGPL-2.0 LGPL-2.1 LGPL-3.0 LiLiQ-P-1.1 LiLiQ-R-1.1 Libpng LPL-1.0 LPL-1.02 LPPL-1.3c MIT MIT-0
Motosoto MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 Multics NASA-1.3 Naumen NCSA NGPL Nokia NPOSL-3.0 NTP OCLC-2.0 ODbL-1.0
ODC-By-1.0 OFL-1.0 OFL-1.1 OLDAP-2.8 OpenSSL OSET-PL-2.1 OSL-1.0 OSL-2.0 OSL-2.1 OSL-3.0 PDDL-1.0 PHP-3.0 PHP-3.01 PostgreSQL
Python-2.0 QPL-1.0 RPL-1.1 RPL-1.5 RPSL-1.0 RSCPL SimPL-2.0 SISSL Sleepycat SPL-1.0 SSPL-1.0 Unicode-DFS-2016 Unlicense UPL-1.0 VSL-1.0
W3C Watcom-1.0 WTFPL X11 Xnet Zlib ZPL-2.0 ZPL-2.1
"""

#: Names of licences, what may stand for them, and the versions that are out: label | names | versions.
NAMED = """
apache | apache license; apache licence; apache software license; asl | 1.0 1.1 2.0
gpl | gnu general public license; gnu gpl; general public license; general public licence; gpl | 1 2 3 1.0 2.0 3.0
lgpl | gnu lesser general public license; lesser general public license; gnu library general public license; library general public license; lgpl | 2 2.1 3 2.0 3.0
agpl | gnu affero general public license; affero general public license; agpl | 1 3 3.0
gfdl | gnu free documentation license; free documentation license; gfdl | 1.1 1.2 1.3
mpl | mozilla public license; mpl | 1.0 1.1 2.0
epl | eclipse public license; epl | 1.0 2.0
cddl | common development and distribution license; cddl | 1.0 1.1
cpl | common public license; cpl | 0.5 1.0
eupl | european union public licence; european union public license; eupl | 1.0 1.1 1.2
artistic | artistic license; perl artistic license; clarified artistic license | 1.0 2.0
osl | open software license; osl | 1.0 1.1 2.0 2.1 3.0
afl | academic free license; afl | 1.1 1.2 2.0 2.1 3.0
cecill | cecill free software license; cecill | 1.0 1.1 2.0 2.1
bsl | boost software license; boost license | 1.0
busl | business source license; busl | 1.0 1.1
sspl | server side public license; sspl | 1
odbl | open database license; odbl | 1.0
ofl | sil open font license; open font license | 1.0 1.1
zpl | zope public license; zpl | 1.0 1.1 2.0 2.1
apsl | apple public source license; apsl | 1.0 1.1 1.2 2.0
php | php license | 2.02 3.0 3.01
python | python software foundation license; python license; psf license | 2 2.0
lppl | latex project public license; lppl | 1.0 1.1 1.2 1.3 1.3c
qpl | q public license; qpl | 1.0
upl | universal permissive license; upl | 1.0
ecl | educational community license; ecl | 1.0 2.0
ms-pl | microsoft public license; ms pl |
ms-rl | microsoft reciprocal license; ms rl |
mulan | mulan permissive software license; mulan psl | 1 2
w3c | w3c software notice and license; w3c license |
openssl | openssl license; ssleay license |
zlib | zlib license; zlib libpng license |
isc | isc license; internet systems consortium license |
ncsa | university of illinois ncsa open source license; ncsa open source license; ncsa license |
postgresql | postgresql license |
unlicense | the unlicense |
wtfpl | do what the fuck you want to public license; wtfpl | 1 2
beerware | beer ware license; beerware license | 42
mit | mit license; mit licence; expat license; x11 license; mit x11 license |
bsd | bsd license; bsd licence; berkeley software distribution license; modified bsd license; simplified bsd license; new bsd license; revised bsd license; original bsd license; freebsd license; freebsd documentation license |
cc0 | cc0; creative commons zero; creative commons public domain dedication | 1.0
pddl | open data commons public domain dedication; pddl | 1.0
odc-by | open data commons attribution license; odc by | 1.0
cern-ohl | cern open hardware licence; cern ohl | 1.1 1.2 2
"""

#: The parts of Creative Commons licences: label | short | long.
CREATIVE_COMMONS = """
cc-by | by | attribution
cc-by-sa | by sa | attribution share ?alike
cc-by-nd | by nd | attribution no ?deriv(?:ative)?s?
cc-by-nc | by nc | attribution non ?commercial
cc-by-nc-sa | by nc sa | attribution non ?commercial share ?alike
cc-by-nc-nd | by nc nd | attribution non ?commercial no ?deriv(?:ative)?s?
"""

#: Typical sentences: label | priority | keyword | pattern.
SENTENCES = r"""
mit | 4 | permission is hereby granted, free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 3 | without restriction | to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell
mit | 2 | shall be included in all copies | the above copyright notice and this permission notice shall be included in all copies or substantial portions
mit | 2 | mit license | (?:released|licensed|distributed|available|offered|provided) under the (?:terms of the )?mit license
mit | 2 | mit licence | (?:released|licensed|distributed|available|offered|provided) under the (?:terms of the )?mit licence
bsd | 4 | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
bsd | 2 | redistributions of source code | redistributions of source code must retain the (?:above )?copyright notice
bsd | 2 | redistributions in binary form | redistributions in binary form must reproduce the (?:above )?copyright notice
bsd-3-clause | 3 | nor the names of | nor the names of (?:its|their|any) contributors may be used to endorse or promote products
bsd-4-clause | 3 | advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-2-clause | 3 | clause | (?:2|two) clause bsd(?: license| licence)?
bsd-3-clause | 3 | clause | (?:3|three) clause bsd(?: license| licence)?
bsd-4-clause | 3 | clause | (?:4|four) clause bsd(?: license| licence)?
isc | 4 | permission to use, copy, modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
hpnd | 3 | permission to use, copy, modify | permission to use copy modify and distribute this software and its documentation for any purpose
apache | 4 | licensed under the apache | licensed under the apache (?:software )?licen[sc]e version 2 0
apache | 2 | you may not use this file | you may not use this file except in compliance with the license
apache | 2 | apache.org/licenses | (?:https? )?www apache org licenses(?: license 2 0)?
gpl | 4 | free software foundation | under the terms of the gnu general public license as published by the free software foundation
gpl | 3 | at your option | either version 2 of the license or at your option any later version
gpl | 3 | at your option | either version 3 of the license or at your option any later version
gpl | 2 | gnu general public | you should have received a copy of the gnu general public license
gpl | 2 | without even the implied warranty | without even the implied warranty of merchantability or fitness for a particular purpose
gpl | 2 | gnu.org/licenses | (?:https? )?(?:www )?gnu org licenses(?: gpl)?
lgpl | 4 | lesser general public | under the terms of the gnu lesser general public license as published by the free software foundation
lgpl | 2 | lesser general public | you should have received a copy of the gnu lesser general public license
agpl | 4 | affero general public | under the terms of the gnu affero general public license as published by the free software foundation
gfdl | 3 | free documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl | 4 | mozilla public license | subject to the terms of the mozilla public license
mpl | 2 | mozilla.org/mpl | (?:https? )?(?:www )?mozilla org mpl
epl | 3 | eclipse public license | this program and the accompanying materials are made available under the terms of the eclipse public license
zlib | 3 | as-is | this software is provided as is without any express or implied warranty
zlib | 3 | altered source versions | altered source versions must be plainly marked as such
bsl | 4 | boost software license | distributed under the boost software license
unlicense | 4 | public domain | this is free and unencumbered software released into the public domain
public-domain | 2 | public domain | (?:released|placed|dedicated|donated) (?:in|into|to) the public domain
public-domain | 1 | public domain | in the public domain
cc0 | 3 | to the extent possible | to the extent possible under law the (?:author|person)
creative-commons | 2 | creativecommons.org | (?:https? )?(?:www )?creativecommons org (?:licenses|publicdomain)
creative-commons | 1 | creative commons | creative commons(?: license| licence)?
proprietary | 2 | all rights reserved | all rights reserved
proprietary | 2 | proprietary | proprietary and confidential
proprietary | 2 | without the prior written | without the prior written (?:permission|consent)
proprietary | 1 | unauthorized | unauthorized (?:copying|reproduction|distribution)
sleepycat | 2 | sleepycat | sleepycat (?:software )?license
json | 3 | good, not evil | the software shall be used for good not evil
openssl | 3 | openssl project | this product includes software developed by the openssl project
artistic | 3 | same terms as perl | (?:under )?the same terms as perl(?: itself)?
generic | 1 | licensed under | licensed under
generic | 1 | licence | (?:terms|conditions) of (?:the|this) licence
generic | 1 | license | (?:terms|conditions) of (?:the|this) license
copyright | 1 | copyright | copyright (?:c )?[0-9]{4}
mit | 3 | the software is provided | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
mit | 2 | in no event shall the authors | in no event shall the authors or copyright holders be liable for any claim damages or other liability
x11 | 3 | x consortium | except as contained in this notice the name of the x consortium shall not be used in advertising
bsd | 2 | this software is provided by | this software is provided by the copyright holders and contributors as is
bsd | 2 | in no event shall the copyright | in no event shall the copyright (?:holder|owner|holders|owners) or contributors be liable
bsd-4-clause | 3 | this product includes software | this product includes software developed by the (?:university of california|regents)
bsd-1-clause | 3 | clause | (?:1|one) clause bsd(?: license| licence)?
bsd-3-clause-clear | 3 | no express or implied licenses | no express or implied licenses to any party s patent rights are granted by this license
0bsd | 3 | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
ntp | 3 | without specific | without specific written prior permission
apache | 3 | grant of patent license | grant of patent license subject to the terms and conditions of this license
apache | 2 | unless required by applicable law | unless required by applicable law or agreed to in writing software distributed under the license
apache | 2 | apache software foundation | (?:developed|distributed|maintained) by the apache software foundation
apache | 1 | asf | licensed to the asf under one or more contributor license agreements
gpl | 3 | this program is free software | this program is free software you can redistribute it and or modify it
gpl | 2 | covered by the gnu | covered by the gnu general public license
gpl | 2 | gplv2 | gplv2(?: only| or later)?
gpl | 2 | gplv3 | gplv3(?: only| or later)?
gpl | 1 | copyleft | copyleft license
lgpl | 3 | this library is free software | this library is free software you can redistribute it and or modify it
lgpl | 2 | lgplv2 | lgplv2(?: 1)?(?: only| or later)?
lgpl | 2 | lgplv3 | lgplv3(?: only| or later)?
agpl | 2 | agplv3 | agplv3(?: only| or later)?
agpl | 3 | remote network interaction | remote network interaction use with the gnu general public license
gpl-exception | 3 | as a special exception | as a special exception (?:the copyright holders|you may|if you link)
gpl-exception | 2 | classpath exception | (?:gnu )?classpath exception
gpl-exception | 2 | gcc runtime library exception | gcc runtime library exception
gfdl | 2 | invariant sections | with no invariant sections(?: no front cover texts)?(?: and no back cover texts)?
mpl | 3 | this source code form | this source code form is subject to the terms of the mozilla public license
mpl | 2 | incompatible with secondary licenses | incompatible with secondary licenses
epl | 2 | eclipse.org/legal | (?:https? )?(?:www )?eclipse org legal(?: epl v[12]0| epl 2 0)?
cddl | 3 | common development and distribution | subject to the terms of the common development and distribution license
eupl | 3 | licensed under the eupl | licensed under the eupl(?: version 1 [0-2])?
osl | 2 | licensed under the open software | licensed under the open software license
artistic | 2 | the standard version of | the standard version of (?:this|the) package
zlib | 2 | origin of this software | the origin of this software must not be misrepresented
zlib | 2 | this notice may not be removed | this notice may not be removed or altered from any source distribution
libpng | 3 | png reference library | the png reference library is supplied as is
libtiff | 3 | sam leffler | the names of sam leffler and silicon graphics may not be used
curl | 3 | daniel stenberg | copyright (?:c )?[0-9]+(?: [0-9]+)? daniel stenberg
ijg | 3 | independent jpeg group | this software is based in part on the work of the independent jpeg group
freetype | 3 | freetype project | portions of this software are copyright (?:c )?(?:[0-9]{4} )?the freetype project
openssl | 3 | written by eric young | this product includes cryptographic software written by eric young
postgresql | 3 | without a written agreement | without fee and without a written agreement is hereby granted
python | 3 | psf is making python available | psf is making python available to licensee on an as is basis
php | 3 | this product includes php | this product includes php software
ruby | 2 | ruby license | (?:the )?ruby license
perl | 2 | under the same terms as perl | under the same terms as perl itself
tcl | 3 | this software is copyrighted by | this software is copyrighted by the regents of the university of california sun microsystems
unlicense | 3 | unlicense.org | (?:https? )?(?:www )?unlicense org
wtfpl | 3 | you just do what the fuck | you just do what the fuck you want to
beerware | 3 | buy me a beer | you can buy me a beer in return
cc0 | 3 | waives all copyright | waives all copyright and related (?:or|and) neighbou?ring rights
cc0 | 2 | no rights reserved | no rights reserved
public-domain | 2 | public domain | (?:has been|is|are) (?:placed|released|put|dedicated) (?:in|into|to) the public domain
public-domain | 2 | disclaims copyright | the author disclaims copyright to this source code
creative-commons | 2 | this work is licensed under | this work is licensed under (?:a|the) creative commons
cc-by | 2 | attribution required | attribution required
cc-by-nc | 1 | non commercial use only | (?:for )?non commercial use only
cc-by-nd | 1 | no derivatives | no derivatives allowed
odbl | 3 | this database is made available | this database is made available under the open database license
ofl | 3 | this font software is licensed | this font software is licensed under the sil open font license
ofl | 2 | reserved font name | with reserved font name
sspl | 3 | offering the program as a service | offering the program as a service
busl | 3 | additional use grant | additional use grant
elastic | 3 | elastic license | elastic license(?: 2 0| v2)?
commons-clause | 3 | commons clause | commons clause(?: license condition)?(?: v1 0)?
polyform | 3 | polyform | polyform (?:noncommercial|small business|shield|strict|perimeter) license
prosperity | 3 | prosperity public license | prosperity public license
parity | 3 | parity public license | parity public license
hippocratic | 3 | hippocratic license | hippocratic license
proprietary | 2 | trade secrets | (?:contains|constitutes) (?:confidential information and )?trade secrets
proprietary | 2 | end user license agreement | end user license agreement
proprietary | 1 | may not be reproduced | may not be reproduced (?:distributed|transmitted|or|in)
proprietary | 1 | internal use only | for internal use only
proprietary | 1 | distribute | do not (?:copy or )?distribute
generic | 1 | dual licensed | dual licensed under
generic | 1 | license file | see the license file(?: for details)?
generic | 1 | licensing terms | licensing terms
generic | 1 | open source license | open source license
copyright | 1 | all rights are reserved | all rights are reserved
"""

#: What may stand between two words.
GAP = r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"
_BEFORE, _AFTER = r"(?<![0-9A-Za-z\x{80}-\x{10FFFF}])", r"(?![0-9A-Za-z\x{80}-\x{10FFFF}])"


def _rows(block: str) -> list[list[str]]:
    return [[part.strip() for part in line.split("|", block.strip().split("\n")[0].count("|"))] for line in block.strip().split("\n")]


def _whole_words(pattern: str) -> str:
    return f"(?i){_BEFORE}(?:{pattern.replace(' ', GAP)}){_AFTER}".replace(f"{GAP}?", f"(?:{GAP})?")


def rules() -> list[Rule]:
    """All rules in order, patterns ready for use."""
    out: list[Rule] = []
    for name in SPDX.split():
        words = " ".join(name.replace(".", " ").replace("-", " ").split())
        out.append((name.lower(), 4, "spdx", f"spdx license identifier {words}(?: (?:only|or later))?"))
    for label, priority, keyword, pattern in _rows(SENTENCES):
        out.append((label, int(priority), keyword, pattern))
    for label, short, long in _rows(CREATIVE_COMMONS):
        out.append((label, 3, f"cc {short}", f"cc {short}(?: [1-4] [05](?: international| unported)?)?"))
        out.append((label, 3, "creative commons", f"creative commons {long}(?: [1-4] [05])?(?: international| unported)?(?: license| licence)?"))
    for label, names, versions in _rows(NAMED):
        for name in names.split("; "):
            if versions:
                numbers = "|".join(v.replace(".", " ") for v in sorted(versions.split(), key=len, reverse=True))
                out.append((label, 3, name, f"{name}(?: v| version| ver)? ?v?(?:{numbers})(?: only| or later)?"))
            out.append((label, 2, name, name))
    return [(label, priority, keyword, _whole_words(pattern)) for label, priority, keyword, pattern in out]
