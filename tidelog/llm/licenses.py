"""License scan: ordered signature rules behind a keyword gate.

A text is lower-cased (A-Z) and cut into words; rules are regular expressions over the words joined by single blanks. A
rule is tried only when its keyword occurs, which every match of its pattern contains, and no rule is tried when the text
holds none of the stems, one of which every match contains. Where detections overlap, one that lies inside another of the
same or a higher priority is suppressed. The base phrases are found beside the rules at every place where their words
stand consecutively, and their labels always stay.

Null and empty texts have no words and no labels. Rows are independent, so repeated rows give repeated results and an empty
table an empty one; other columns, whatever their names, are ignored. Of detections of one stretch by rules of one priority
the rule written first stays. Very long texts are scanned whole; memory follows the longest one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._text import column_of, raw, slices, spans, table_of, texts

#: Bytes of words: digits, letters, and everything beyond ASCII.
WORD = table_of((48, 57), (65, 90), (97, 122), (128, 255))
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
BASE = {b"under the mit license": "mit", b"apache license version 2": "apache-2", b"cc by nc": "cc-by-nc"}


class Rule(NamedTuple):
    label: str
    priority: int  # larger wins
    keyword: bytes
    pattern: re.Pattern
    score: float


# label ; names, as patterns over words joined by blanks, most telling first
FAMILIES = r"""
mit ; (?:the )?mit (?:expat )?licen[sc]e|licen[sc]ed under (?:the )?mit|expat licen[sc]e
mit-0 ; mit no attribution(?: licen[sc]e)?
apache-2 ; apache (?:software )?licen[sc]e (?:version |v )?2(?: 0)?|apache 2(?: 0)? licen[sc]e|licen[sc]ed under (?:the )?apache 2
apache-1.1 ; apache (?:software )?licen[sc]e (?:version |v )?1 1
apache-1.0 ; apache (?:software )?licen[sc]e (?:version |v )?1 0
gpl-3 ; gnu general public licen[sc]e(?: gpl)? (?:version |v )?3(?: 0)?(?: or (?:any )?later)?|gnu gpl (?:version |v)?3
gpl-2 ; gnu general public licen[sc]e(?: gpl)? (?:version |v )?2(?: 0)?(?: or (?:any )?later)?|gnu gpl (?:version |v)?2
gpl-1 ; gnu general public licen[sc]e(?: gpl)? (?:version |v )?1(?: 0)?
gpl ; gnu general public licen[sc]e
lgpl-3 ; gnu lesser general public licen[sc]e(?: lgpl)? (?:version |v )?3(?: 0)?
lgpl-2.1 ; gnu lesser general public licen[sc]e(?: lgpl)? (?:version |v )?2 1
lgpl-2 ; gnu library general public licen[sc]e(?: lgpl)? (?:version |v )?2(?: 0)?
lgpl ; gnu lesser general public licen[sc]e
agpl-3 ; gnu affero general public licen[sc]e(?: agpl)?(?: (?:version |v )?3(?: 0)?)?
agpl-1 ; affero general public licen[sc]e (?:version |v )?1
gfdl-1.3 ; gnu free documentation licen[sc]e(?: (?:version |v )?1 3)?
gfdl-1.2 ; gnu free documentation licen[sc]e (?:version |v )?1 2
gfdl-1.1 ; gnu free documentation licen[sc]e (?:version |v )?1 1
bsd-2-clause ; (?:simplified|freebsd|2 clause) bsd licen[sc]e|bsd 2 clause(?: licen[sc]e)?
bsd-3-clause ; (?:new|revised|modified|3 clause) bsd licen[sc]e|bsd 3 clause(?: licen[sc]e)?
bsd-4-clause ; (?:original|old|4 clause) bsd licen[sc]e|bsd 4 clause(?: licen[sc]e)?
bsd-0-clause ; (?:zero clause|0 clause|free public) bsd licen[sc]e|bsd zero clause(?: licen[sc]e)?
bsd ; (?:under (?:the |a )?)?bsd(?: style)? licen[sc]e
isc ; isc licen[sc]e|internet systems consortium licen[sc]e
mpl-2 ; mozilla public licen[sc]e(?: mpl)? (?:version |v )?2(?: 0)?
mpl-1.1 ; mozilla public licen[sc]e(?: mpl)? (?:version |v )?1 1
mpl-1.0 ; mozilla public licen[sc]e(?: mpl)? (?:version |v )?1 0
mpl ; mozilla public licen[sc]e
epl-2 ; eclipse public licen[sc]e(?: epl)? (?:version |v )?2(?: 0)?
epl-1 ; eclipse public licen[sc]e(?: epl)? (?:version |v )?1(?: 0)?
edl-1 ; eclipse distribution licen[sc]e(?: (?:version |v )?1(?: 0)?)?
cddl-1.1 ; common development and distribution licen[sc]e(?: cddl)? (?:version |v )?1 1
cddl-1.0 ; common development and distribution licen[sc]e(?: cddl)?(?: (?:version |v )?1(?: 0)?)?
cpl-1 ; common public licen[sc]e(?: (?:version |v )?1(?: 0)?)?
cpal-1 ; common public attribution licen[sc]e(?: (?:version |v )?1(?: 0)?)?
eupl-1.2 ; european union public licen[sc]e(?: eupl)? (?:version |v )?1 2
eupl-1.1 ; european union public licen[sc]e(?: eupl)? (?:version |v )?1 1
eupl ; european union public licen[sc]e
artistic-2 ; artistic licen[sc]e (?:version |v )?2(?: 0)?
artistic-1 ; artistic licen[sc]e(?: (?:version |v )?1(?: 0)?)?
bsl-1 ; boost software licen[sc]e(?: (?:version |v )?1(?: 0)?)?
busl-1.1 ; business source licen[sc]e(?: (?:version |v )?1 1)?
sspl-1 ; server side public licen[sc]e(?: (?:version |v )?1)?
elastic-2 ; elastic licen[sc]e(?: (?:version |v )?2(?: 0)?)?
zlib ; zlib(?: libpng)? licen[sc]e
libpng ; png reference library licen[sc]e|libpng licen[sc]e
openssl ; openssl licen[sc]e
ssleay ; (?:original )?ssleay licen[sc]e
psf-2 ; python software foundation licen[sc]e(?: (?:version |v )?2)?|psf licen[sc]e
ruby ; ruby licen[sc]e|ruby s licen[sc]e
php-3 ; php licen[sc]e(?: (?:version |v )?3(?: 01?)?)?
perl ; same terms as perl(?: itself)?
ofl-1.1 ; sil open font licen[sc]e(?: (?:version |v )?1 1)?
ms-pl ; microsoft public licen[sc]e
ms-rl ; microsoft reciprocal licen[sc]e
ncsa ; university of illinois(?: ncsa)? open source licen[sc]e
osl-3 ; open software licen[sc]e(?: (?:version |v )?3(?: 0)?)?
afl-3 ; academic free licen[sc]e(?: (?:version |v )?3(?: 0)?)?
ecl-2 ; educational community licen[sc]e(?: (?:version |v )?2(?: 0)?)?
upl-1 ; universal permissive licen[sc]e(?: (?:version |v )?1(?: 0)?)?
vim ; vim licen[sc]e
wtfpl ; wtfpl|do what the f[a-z]* you want to public licen[sc]e
unlicense ; (?:the )?unlicense
postgresql ; postgresql licen[sc]e
qpl-1 ; q public licen[sc]e(?: (?:version |v )?1(?: 0)?)?
lppl-1.3 ; latex project public licen[sc]e(?: (?:version |v )?1 3c?)?
ipl-1 ; ibm public licen[sc]e(?: (?:version |v )?1(?: 0)?)?
apsl-2 ; apple public source licen[sc]e(?: (?:version |v )?2(?: 0)?)?
cecill-2.1 ; cecill(?: free software)? licen[sc]e(?: agreement)?(?: (?:version |v )?2 1)?|licence cecill
cecill-b ; cecill b(?: licen[sc]e)?
cecill-c ; cecill c(?: licen[sc]e)?
mulan-2 ; mulan psl (?:version |v)?2|mulan permissive software licen[sc]e
odbl-1 ; open (?:data commons open )?database licen[sc]e(?: odbl)?
odc-by-1 ; open data commons attribution licen[sc]e
pddl-1 ; open data commons public domain dedication(?: and)? licen[sc]e
ogl-3 ; open government licen[sc]e(?: (?:version |v )?3(?: 0)?)?
bsd-2-clause-patent ; bsd 2 clause plus patent(?: licen[sc]e)?|bsd plus patent licen[sc]e
bsd-3-clause-clear ; clear bsd licen[sc]e|bsd 3 clause clear
x11 ; x11 licen[sc]e|mit x11 licen[sc]e
ntp ; ntp licen[sc]e
curl ; curl licen[sc]e
icu ; icu licen[sc]e
unicode ; unicode licen[sc]e(?: v3)?|unicode data files and software licen[sc]e
w3c ; w3c software notice and licen[sc]e|w3c software and document (?:notice and )?licen[sc]e
tcl ; tcl tk licen[sc]e
hpnd ; historical permission notice and disclaimer
beerware ; beer ?ware licen[sc]e
json ; json licen[sc]e
bouncy-castle ; bouncy castle licen[sc]e
sleepycat ; sleepycat (?:public )?licen[sc]e
nasa-1.3 ; nasa open source agreement(?: 1 3)?
intel ; intel open source licen[sc]e
lpl-1.02 ; lucent public licen[sc]e(?: (?:version |v )?1 02)?
rpl-1.5 ; reciprocal public licen[sc]e(?: (?:version |v )?1 5)?
spl-1 ; sun public licen[sc]e(?: (?:version |v )?1(?: 0)?)?
sissl ; sun industry standards source licen[sc]e
cua-opl-1 ; cua office public licen[sc]e
nokia ; nokia open source licen[sc]e
ms-lpl ; microsoft limited public licen[sc]e
open-gaming ; open game licen[sc]e|open gaming licen[sc]e
cdla-permissive ; community data licen[sc]e agreement permissive
cdla-sharing ; community data licen[sc]e agreement sharing
openrail ; (?:bigcode |creativeml |bigscience )?openrail(?: m)?(?: licen[sc]e)?
llama ; llama [2-4](?: [0-9])? community licen[sc]e
gemma ; gemma terms of use
polyform-noncommercial ; polyform noncommercial licen[sc]e
polyform-small-business ; polyform small business licen[sc]e
commons-clause ; commons clause licen[sc]e condition
hippocratic ; hippocratic licen[sc]e
parity ; parity public licen[sc]e
prosperity ; prosperity public licen[sc]e
anti-996 ; anti 996 licen[sc]e
eudatagrid ; eu datagrid software licen[sc]e
zpl-2 ; zope public licen[sc]e(?: (?:version |v )?2 [01])?
ijg ; independent jpeg group(?: s)? licen[sc]e
freetype ; freetype (?:project )?licen[sc]e
imagemagick ; imagemagick licen[sc]e
libtiff ; libtiff licen[sc]e
bzip2 ; bzip2(?: and libbzip2)? licen[sc]e
info-zip ; info zip licen[sc]e
naumen ; naumen public licen[sc]e
oclc-2 ; oclc research public licen[sc]e
vovida ; vovida software licen[sc]e
watcom-1 ; sybase open watcom public licen[sc]e
cnri ; cnri (?:python )?licen[sc]e
entessa ; entessa public licen[sc]e
fair ; fair licen[sc]e
frameworx ; frameworx open licen[sc]e
multics ; multics licen[sc]e
miros ; miros licen[sc]e
nposl-3 ; non profit open software licen[sc]e
ogtsl ; open group test suite licen[sc]e
simple-2 ; simple public licen[sc]e
ucl-1 ; upstream compatibility licen[sc]e
osgi ; osgi specification licen[sc]e
etalab-2 ; etalab (?:open )?licen[sc]e|licence ouverte(?: open licence)?
dl-de-by-2 ; data licence germany attribution|datenlizenz deutschland namensnennung
cern-ohl-p-2 ; cern open hardware licen[sc]e(?: version 2)? permissive
cern-ohl-s-2 ; cern open hardware licen[sc]e(?: version 2)? strongly reciprocal
solderpad ; solderpad hardware licen[sc]e
gust ; gust font licen[sc]e
free-art ; free art licen[sc]e|licence art libre
cc0 ; cc0(?: 1 0)?(?: universal)?
cc0 ; creative commons (?:zero|cc0)(?: 1 0)?|creative commons public domain dedication
cc-by-nc-nd ; cc by nc nd(?: [1-4] [05])?
cc-by-nc-sa ; cc by nc sa(?: [1-4] [05])?
cc-by-nc ; cc by nc(?: [1-4] [05])?
cc-by-nd ; cc by nd(?: [1-4] [05])?
cc-by-sa ; cc by sa(?: [1-4] [05])?
cc-by ; cc by(?: [1-4] [05])?
cc-by-nc-nd ; creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?
cc-by-nc-sa ; creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?
cc-by-nc ; creative commons attribution non ?commercial(?: [1-4] [05])?
cc-by-nd ; creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?
cc-by-sa ; creative commons attribution share ?alike(?: [1-4] [05])?
cc-by ; creative commons attribution(?: [1-4] [05])?
cc-by-nc-nd ; creativecommons org licenses by nc nd
cc-by-nc-sa ; creativecommons org licenses by nc sa
cc-by-nc ; creativecommons org licenses by nc
cc-by-nd ; creativecommons org licenses by nd
cc-by-sa ; creativecommons org licenses by sa
cc-by ; creativecommons org licenses by
cc0 ; creativecommons org publicdomain zero
"""

# label ; a sentence of the license's own text
NOTICES = r"""
mit ; permission is hereby granted free of charge to any person obtaining a copy of this software
isc ; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd ; redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause ; neither the name of [a-z0-9 ]{1,80} nor the names of its contributors may be used to endorse or promote
bsd-4-clause ; all advertising materials mentioning features or use of this software must display
apache-2 ; you may not use this file except in compliance with the licen[sc]e
apache-2 ; apache org licenses license 2 0
gpl ; this program is free software you can redistribute it and or modify it under the terms of the gnu general public
lgpl ; this library is free software you can redistribute it and or modify it under the terms of the gnu lesser
agpl-3 ; remote network interaction use with the gnu general public
mpl-2 ; this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0
zlib ; altered source versions must be plainly marked as such
bsl-1 ; permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
unlicense ; this is free and unencumbered software released into the public domain
gpl-3 ; either version 3 of the licen[sc]e or at your option any later version
gpl-2 ; either version 2 of the licen[sc]e or at your option any later version
lgpl-2.1 ; either version 2 1 of the licen[sc]e or at your option any later version
gpl ; you should have received a copy of the gnu general public licen[sc]e
lgpl ; you should have received a copy of the gnu lesser general public licen[sc]e
agpl-3 ; you should have received a copy of the gnu affero general public licen[sc]e
gpl ; everyone is permitted to copy and distribute verbatim copies of this licen[sc]e document
gpl ; under the terms of the (?:gnu )?gpl
mit ; the above copyright notice and this permission notice shall be included in all copies
apache-2 ; unless required by applicable law or agreed to in writing software distributed under the licen[sc]e
epl-2 ; accompanying materials are made available under the terms of the eclipse public licen[sc]e (?:v )?2 0
epl-1 ; accompanying materials are made available under the terms of the eclipse public licen[sc]e v1 0
cddl-1.0 ; subject to the terms of the common development and distribution licen[sc]e
perl ; the same terms as the perl 5 programming language
cc-by ; this work is licen[sc]ed under a creative commons attribution [1-4] [05] international licen[sc]e
ofl-1.1 ; this font software is licen[sc]ed under the sil open font licen[sc]e
bsl-1 ; distributed under the boost software licen[sc]e
zlib ; the origin of this software must not be misrepresented
zlib ; this notice may not be removed or altered from any source distribution
unlicense ; anyone is free to copy modify publish use compile sell or distribute this software
bsd ; redistributions of source code must retain the above copyright notice
bsd ; redistributions in binary form must reproduce the above copyright notice
isc ; the author disclaims all warranties with regard to this software
postgresql ; permission to use copy modify and distribute this software and its documentation for any purpose without fee
hpnd ; permission to use copy modify distribute and sell this software and its documentation for any purpose is hereby granted without fee
wtfpl ; everyone is permitted to copy and distribute verbatim or modified copies of this licen[sc]e document
json ; the software shall be used for good not evil
beerware ; as long as you retain this notice you can do whatever you want with this stuff
cc0 ; to the extent possible under law the (?:person|author) who associated cc0
public-domain ; this (?:work|software|file|code) is in the public domain
public-domain ; (?:released|dedicated|placed) (?:in|into|to) the public domain
wtfpl ; you just do what the f[a-z]* you want to
cc0 ; waived all copyright and related or neighboring rights
ofl-1.1 ; with reserved font name
proprietary ; all rights reserved
proprietary ; proprietary and confidential|confidential and proprietary
proprietary ; without (?:the )?(?:prior )?written (?:permission|consent)
proprietary ; unauthorized copying of this file via any medium is strictly prohibited
proprietary ; no part of this (?:publication|document|book|work) may be reproduced
proprietary ; licen[sc]ed material property of
no-warranty ; in the hope that it will be useful but without any warranty
no-warranty ; without warranties or conditions of any kind either express or implied
no-warranty ; provided as is without (?:any )?warrant(?:y|ies)
copyright ; copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?
"""

# label ; its identifiers after a machine-readable tag, as words
IDENTIFIERS = r"""
mit ; mit
mit-0 ; mit 0
bsd-0-clause ; 0bsd
bsd-2-clause ; bsd 2 clause
bsd-2-clause-patent ; bsd 2 clause patent
bsd-3-clause ; bsd 3 clause
bsd-3-clause-clear ; bsd 3 clause clear
bsd-4-clause ; bsd 4 clause
apache-2 ; apache 2(?: 0)?
apache-1.1 ; apache 1 1
apache-1.0 ; apache 1 0
gpl-3 ; gpl 3(?: 0)?(?: only| or later)?
gpl-2 ; gpl 2(?: 0)?(?: only| or later)?
gpl-1 ; gpl 1(?: 0)?(?: only| or later)?
lgpl-3 ; lgpl 3(?: 0)?(?: only| or later)?
lgpl-2.1 ; lgpl 2 1(?: only| or later)?
lgpl-2 ; lgpl 2 0(?: only| or later)?
agpl-3 ; agpl 3(?: 0)?(?: only| or later)?
agpl-1 ; agpl 1(?: 0)?(?: only| or later)?
gfdl-1.3 ; gfdl 1 3(?: no invariants)?(?: only| or later)?
gfdl-1.2 ; gfdl 1 2(?: no invariants)?(?: only| or later)?
gfdl-1.1 ; gfdl 1 1(?: no invariants)?(?: only| or later)?
isc ; isc
mpl-2 ; mpl 2(?: 0)?(?: no copyleft exception)?
mpl-1.1 ; mpl 1 1
mpl-1.0 ; mpl 1 0
epl-2 ; epl 2(?: 0)?
epl-1 ; epl 1(?: 0)?
cddl-1.1 ; cddl 1 1
cddl-1.0 ; cddl 1 0
cpl-1 ; cpl 1 0
cpal-1 ; cpal 1 0
eupl-1.2 ; eupl 1 2
eupl-1.1 ; eupl 1 1
artistic-2 ; artistic 2(?: 0)?
artistic-1 ; artistic 1 0(?: perl| cl8)?
bsl-1 ; bsl 1(?: 0)?
busl-1.1 ; busl 1 1
sspl-1 ; sspl 1(?: 0)?
elastic-2 ; elastic 2(?: 0)?
zlib ; zlib(?: acknowledgement)?
libpng ; libpng(?: 2 0)?
openssl ; openssl
psf-2 ; psf 2(?: 0)?
psf-2 ; python 2 0
ruby ; ruby
php-3 ; php 3 0(?:1)?
ofl-1.1 ; ofl 1 1(?: rfn| no rfn)?
ms-pl ; ms pl
ms-rl ; ms rl
ncsa ; ncsa
osl-3 ; osl 3(?: 0)?
afl-3 ; afl 3(?: 0)?
ecl-2 ; ecl 2(?: 0)?
upl-1 ; upl 1(?: 0)?
vim ; vim
wtfpl ; wtfpl
unlicense ; unlicense
postgresql ; postgresql
qpl-1 ; qpl 1(?: 0)?
lppl-1.3 ; lppl 1 3[ac]
ipl-1 ; ipl 1(?: 0)?
apsl-2 ; apsl 2(?: 0)?
cecill-2.1 ; cecill 2 1
cecill-b ; cecill b
cecill-c ; cecill c
mulan-2 ; mulanpsl 2(?: 0)?
odbl-1 ; odbl 1(?: 0)?
odc-by-1 ; odc by 1(?: 0)?
pddl-1 ; pddl 1(?: 0)?
ogl-3 ; ogl uk 3(?: 0)?
cc0 ; cc0 1 0
cc-by ; cc by [1-4] [05]
cc-by-sa ; cc by sa [1-4] [05]
cc-by-nc ; cc by nc [1-4] [05]
cc-by-nd ; cc by nd [1-4] [05]
cc-by-nc-sa ; cc by nc sa [1-4] [05]
cc-by-nc-nd ; cc by nc nd [1-4] [05]
x11 ; x11
ntp ; ntp
curl ; curl
icu ; icu
unicode ; unicode (?:3 0|dfs 201[56]|tou)
w3c ; w3c(?: 20150513)?
tcl ; tcl
hpnd ; hpnd
beerware ; beerware
json ; json
sleepycat ; sleepycat
nasa-1.3 ; nasa 1 3
rpl-1.5 ; rpl 1 5
spl-1 ; spl 1 0
sissl ; sissl
cdla-permissive ; cdla permissive [12] 0
cdla-sharing ; cdla sharing 1 0
polyform-noncommercial ; polyform noncommercial 1 0 0
polyform-small-business ; polyform small business 1 0 0
zpl-2 ; zpl 2 [01]
ijg ; ijg
freetype ; ftl
imagemagick ; imagemagick
libtiff ; libtiff
bzip2 ; bzip2 1 0 6
info-zip ; info zip
nposl-3 ; nposl 3 0
etalab-2 ; etalab 2 0
cern-ohl-p-2 ; cern ohl p 2 0
cern-ohl-s-2 ; cern ohl s 2 0
"""
#: Priorities: identifiers after a tag, sentences of a license, names with a version, names without, hints that name none.
TAGGED, SENTENCE, VERSIONED, NAMED, HINT = 40, 30, 20, 15, 5
_HINTS = ("copyright", "no-warranty", "proprietary")


def alternatives(pattern: str) -> list[str]:
    """The pattern cut at each | outside of groups."""
    out, depth = [""], 0
    for c in pattern:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def keyword_of(pattern: str) -> bytes:
    """A stretch of characters that every match contains, so outside of groups and classes: the longest without "licen"."""
    rest, n = re.sub(r"\[[^]]*\](?:[?*+]|\{[^}]*\})?", "\0", pattern), 1
    while n:
        rest, n = re.subn(r"\([^()]*\)[?*+]?", "\0", rest)
    found = max(reversed(re.sub(r".[?*]", "\0", rest).split("\0")), key=lambda x: len(x.replace("licen", "")))
    if len(found) < 3 or re.search(r"[^a-z0-9 ]", found):
        raise ValueError(f"no keyword in {pattern}")
    return found.encode()


def rules() -> list[Rule]:
    """All rules, one for each alternative, the highest priority first, and in each priority as they are written."""
    out = []
    lines = lambda block: [(label, p) for row in block.strip().split("\n") for label, _, names in [row.partition(" ; ")] for p in alternatives(names)]
    whole = lambda p: re.compile(rb" (?:" + p.encode() + rb")(?= )")
    for label, pattern in lines(IDENTIFIERS):
        out.append(Rule(label, TAGGED, b"identifier ", whole(f"spdx licen[sc]e identifier {pattern}"), 1.0))
    for label, pattern in lines(NOTICES):
        hint = label in _HINTS
        out.append(Rule(label, HINT if hint else SENTENCE, keyword_of(pattern), whole(pattern), 0.4 if hint else 0.95))
    for label, pattern in lines(FAMILIES):
        versioned = bool(re.search(r"[0-9]", label)) or label.startswith("cc")
        lead = "(?:released |licen[sc]ed |distributed )?(?:under )?(?:the )?"
        out.append(Rule(label, VERSIONED if versioned else NAMED, keyword_of(pattern), whole(f"{lead}(?:{pattern})"), 0.9 if versioned else 0.8))
    return sorted(out, key=lambda r: -r.priority)


RULES = rules()
#: A text that no stem occurs in matches no rule and no base phrase. Blanks stand for any gap between words.
STEMS = ("licen", "copyright", "spdx", "wtfpl", "cc0", "mulan", "cecill", "creativecommons", "proprietary", "permission", "permitted", "commons", "same terms", "public domain", "written", "reserved", "warrant", "neighboring", "compliance", "altered source", "advertising", "redistribut", "remote network", "gpl", "do what", "cc by", "apache", "psl", "contributors", "bsd", "mit no", "historical", "nasa open", "openrail", "gemma terms", "misrepresented", "source distribution", "anyone is free", "disclaims", "good not evil", "retain", "unauthorized copying", "no part of this", "hope that it", "associated cc0", "datenlizenz")
_GATE = re.compile("|".join(re.escape(s).replace(r"\ ", r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+") for s in STEMS).encode())


class Detection(NamedTuple):
    label: str
    start: int  # in bytes of the joined words
    end: int
    priority: int
    score: float


def detect(joined: bytes) -> list[Detection]:
    """Detections in words joined and framed by blanks that no detection of at least their priority contains."""
    found: list[Detection] = []
    present: dict[bytes, bool] = {}
    for r in RULES:
        if r.keyword not in present:
            present[r.keyword] = r.keyword in joined
        if present[r.keyword]:
            found += (Detection(r.label, m.start(), m.end(), r.priority, r.score) for m in r.pattern.finditer(joined))
    # by start, then the widest and highest first: only an earlier one can contain a later one
    found.sort(key=lambda d: (d.start, -d.end, -d.priority))
    kept: list[Detection] = []
    reach: dict[int, int] = {}  # furthest end so far, by priority
    for d in found:
        if not any(end >= d.end for priority, end in reach.items() if priority >= d.priority):
            kept.append(d)
        reach[d.priority] = max(reach.get(d.priority, 0), d.end)
    # wider ones that start later can't contain; those of lower priority that start earlier don't suppress
    return kept


def base_places(joined: bytes) -> list[tuple[int, str]]:
    """Word index and label of every place of a base phrase."""
    out = []
    for phrase, label in BASE.items():
        at, words, since = joined.find(b" " + phrase + b" "), 0, 0
        while at >= 0:
            words, since = words + joined.count(b" ", since, at), at
            out.append((words, label))
            at = joined.find(b" " + phrase + b" ", at + 1)
    return out


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base places (n_base, first_word, last_word, base_labels), labels, score and n_detections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, at = raw(texts(column_of(b, "text")))
            _, _, doc = spans(WORD[data], at)
            n_words = np.bincount(doc, minlength=b.num_rows).astype(np.int64)
            rows = []
            for i, j in zip(at.tolist(), at[1:].tolist(), strict=False):
                low = data[i:j].tobytes().lower()
                if not _GATE.search(low):
                    rows.append((0, None, None, "", "", 0.0, 0))
                    continue
                joined = b" " + b" ".join(_WORD.findall(low)) + b" "
                base, found = base_places(joined), detect(joined)
                own = {label for _, label in base}
                where = [w for w, _ in base]
                labels = own | {d.label for d in found}
                score = max([d.score for d in found] + [0.9] * bool(base), default=0.0)
                rows.append((len(base), min(where, default=None), max(where, default=None), ",".join(sorted(own)), ",".join(sorted(labels)), score, len(found)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64())
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_detections"]
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), pa.array(n_words), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_detections long")
