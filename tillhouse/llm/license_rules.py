"""Signature rules of licences: hand-written patterns over lower-case words with single spaces between.

Each line: label | name | SPDX ids | address. The first word in braces of a name is its keyword: a
document without it is not searched by the rules of that name. `<2.1>` stands for that version, with
or without "version" or "v" before it, and `<2.0>` for 2 as well.
"""

from __future__ import annotations

import re
from typing import NamedTuple

TABLE = r"""
gpl-3.0 | {gnu} (?:general public licen[cs]e|gpl) <3.0> | gpl 3 0(?: only| or later)? | gnu org licenses gpl 3 0(?: en)?(?: html| txt)?
gpl-2.0 | {gnu} (?:general public licen[cs]e|gpl) <2.0> | gpl 2 0(?: only| or later)? | gnu org licenses (?:old licenses )?gpl 2 0(?: en)?(?: html| txt)?
gpl-1.0 | {gnu} (?:general public licen[cs]e|gpl) <1.0> | gpl 1 0(?: only| or later)? | gnu org licenses old licenses gpl 1 0(?: html| txt)?
gpl-3.0 | {gplv3}(?: or later)? | gpl 3(?: 0)? | gnu org licenses quick guide gplv3(?: html)?
gpl-2.0 | {gplv2}(?: or later)? | gpl 2(?: 0)? | opensource org licenses gpl 2 0(?: php)?
gpl | {gnu} (?:general public licen[cs]e|gpl) | gpl | gnu org (?:licenses|copyleft) gpl(?: html| txt)?
lgpl-3.0 | {gnu} (?:lesser general public licen[cs]e|lgpl) <3.0> | lgpl 3 0(?: only| or later)? | gnu org licenses lgpl 3 0(?: html| txt)?
lgpl-2.1 | {gnu} (?:lesser general public licen[cs]e|lgpl) <2.1> | lgpl 2 1(?: only| or later)? | gnu org licenses (?:old licenses )?lgpl 2 1(?: html| txt)?
lgpl-2.0 | {gnu} (?:library|lesser) general public licen[cs]e <2.0> | lgpl 2 0(?: only| or later)? | gnu org licenses old licenses lgpl 2 0(?: html| txt)?
lgpl | {gnu} (?:lesser|library) general public licen[cs]e | lgpl | gnu org (?:licenses|copyleft) (?:lgpl|lesser)(?: html| txt)?
agpl-3.0 | {affero} general public licen[cs]e <3.0> | agpl 3 0(?: only| or later)? | gnu org licenses agpl 3 0(?: html| txt)?
agpl-1.0 | {affero} general public licen[cs]e <1.0> | agpl 1 0(?: only| or later)? | affero org oagpl(?: html)?
agpl | (?:gnu )?{affero} (?:general public licen[cs]e|gpl) | agpl | gnu org licenses agpl(?: html| txt)?
gfdl-1.3 | {gnu} free documentation licen[cs]e <1.3> | gfdl 1 3(?: only| or later)? | gnu org licenses fdl 1 3(?: html| txt)?
gfdl-1.2 | {gnu} free documentation licen[cs]e <1.2> | gfdl 1 2(?: only| or later)? | gnu org licenses (?:old licenses )?fdl 1 2(?: html| txt)?
gfdl | {gnu} free documentation licen[cs]e | gfdl | gnu org (?:licenses|copyleft) fdl(?: html| txt)?
apache-2.0 | {apache} (?:software )?licen[cs]e <2.0> | apache 2 0 | apache org licenses license 2 0(?: html| txt)?
apache-1.1 | {apache} (?:software )?licen[cs]e <1.1> | apache 1 1 | apache org licenses license 1 1(?: html| txt)?
apache-1.0 | {apache} (?:software )?licen[cs]e <1.0> | apache 1 0 | apache org licenses license 1 0(?: html| txt)?
apache | {apache} (?:software )?licen[cs]e | apache | apache org licenses
mit | {mit} licen[cs]e | mit | opensource org licen[cs]es? mit(?: license)?(?: php| html)?
mit | {expat} licen[cs]e | expat | directory fsf org wiki license expat
mit-0 | {mit} no attribution(?: licen[cs]e)? | mit 0 | github com aws mit 0
mit | {permission} is hereby granted free of charge to any person obtaining a copy | mit license | spdx org licenses mit(?: html)?
x11 | {x11} (?:mit )?licen[cs]e | x11 | xfree86 org 3 3 6 copyright2(?: html)?
bsd-2-clause | {bsd} (?:2|two) clause(?: licen[cs]e)? | bsd 2 clause | opensource org licen[cs]es? bsd 2 clause(?: php| html)?
bsd-2-clause | (?:2|two) clause {bsd}(?: licen[cs]e)? | bsd 2 clause simplified | spdx org licenses bsd 2 clause(?: html)?
bsd-2-clause | simplified {bsd} licen[cs]e | bsd 2 clause views | freebsd org copyright freebsd license(?: html)?
bsd-3-clause | {bsd} (?:3|three) clause(?: licen[cs]e)? | bsd 3 clause | opensource org licen[cs]es? bsd 3 clause(?: php| html)?
bsd-3-clause | (?:3|three) clause {bsd}(?: licen[cs]e)? | bsd 3 clause clear | spdx org licenses bsd 3 clause(?: html)?
bsd-3-clause | (?:new|revised|modified) {bsd} licen[cs]e | bsd new | opensource org licenses bsd license(?: php)?
bsd-4-clause | (?:original|4 clause|four clause) {bsd}(?: licen[cs]e)? | bsd 4 clause(?: uc)? | spdx org licenses bsd 4 clause(?: html)?
bsd | {redistribution} and use in source and binary forms with or without modification | bsd source code | directory fsf org wiki license bsd 4clause
0bsd | (?:zero clause|0 clause) {bsd}(?: licen[cs]e)? | 0bsd | landley net toybox license(?: html)?
bsd | {bsd}(?: style)? licen[cs]e | bsd | xfree86 org 3 3 6 copyright2 html 5
isc | {isc} licen[cs]e | isc | opensource org licen[cs]es? isc(?: license)?(?: txt)?
isc | {permission} to use copy modify and(?: or)? distribute this software for any purpose | isc license | isc org licenses
mpl-2.0 | {mozilla} public licen[cs]e <2.0> | mpl 2 0(?: no copyleft exception)? | mozilla org (?:en us )?mpl 2 0
mpl-1.1 | {mozilla} public licen[cs]e <1.1> | mpl 1 1 | mozilla org mpl mpl 1 1(?: html| txt)?
mpl-1.0 | {mozilla} public licen[cs]e <1.0> | mpl 1 0 | mozilla org mpl mpl 1 0(?: html| txt)?
mpl | {mozilla} public licen[cs]e | mpl | mozilla org mpl
epl-2.0 | {eclipse} public licen[cs]e <2.0> | epl 2 0 | eclipse org legal epl 2 0(?: html)?
epl-1.0 | {eclipse} public licen[cs]e <1.0> | epl 1 0 | eclipse org legal epl v10(?: html)?
epl | {eclipse} public licen[cs]e | epl | eclipse org legal epl
edl-1.0 | {eclipse} distribution licen[cs]e | edl 1 0 | eclipse org org documents edl v10(?: html| php)?
cddl-1.1 | {common} development and distribution licen[cs]e <1.1> | cddl 1 1 | glassfish java net public cddl gpl 1 1(?: html)?
cddl-1.0 | {common} development and distribution licen[cs]e(?: <1.0>)? | cddl 1 0 | opensource org licenses cddl1(?: php| txt)?
cpl-1.0 | {common} public licen[cs]e(?: <1.0>)? | cpl 1 0 | opensource org licenses cpl1 0(?: php| txt)?
cpal-1.0 | {common} public attribution licen[cs]e(?: <1.0>)? | cpal 1 0 | opensource org licenses cpal 1 0
eupl-1.2 | {european} union public licen[cs]e <1.2> | eupl 1 2 | joinup ec europa eu collection eupl eupl text eupl 12
eupl-1.1 | {european} union public licen[cs]e <1.1> | eupl 1 1 | ec europa eu idabc eupl
eupl | {european} union public licen[cs]e | eupl | joinup ec europa eu software page eupl
cecill-2.1 | {cecill} (?:free software licen[cs]e )?(?:agreement )?<2.1> | cecill 2 1 | cecill info licences licence cecill v2 1(?: en| fr)?(?: html| txt)?
cecill | {cecill}(?: [bc])? licen[cs]e | cecill(?: [bc])? | cecill info licences
artistic-2.0 | {artistic} licen[cs]e <2.0> | artistic 2 0 | opensource org licenses artistic license 2 0(?: php)?
artistic-1.0 | {artistic} licen[cs]e <1.0> | artistic 1 0(?: perl| cl8)? | opensource org licenses artistic license 1 0
artistic | (?:perl )?{artistic} licen[cs]e | artistic | perlfoundation org artistic license
bsl-1.0 | {boost} software licen[cs]e(?: <1.0>)? | bsl 1 0 | boost org license 1 0(?: txt)?
busl-1.1 | {business} source licen[cs]e(?: <1.1>)? | busl 1 1 | mariadb com bsl11
zlib | {zlib}(?: libpng)? licen[cs]e | zlib | zlib net zlib license(?: html)?
libpng | {libpng} licen[cs]e(?: <2.0>)? | libpng(?: 2 0)? | libpng org pub png src libpng license(?: txt)?
unlicense | the {unlicense} | unlicense | unlicense org
wtfpl | do what the f[a-z]* you want to {public} licen[cs]e | wtfpl | wtfpl net
cc0-1.0 | {cc0}(?: <1.0>)?(?: universal)? | cc0 1 0 | creativecommons org publicdomain zero 1 0
cc0-1.0 | creative {commons} zero(?: <1.0>)?(?: universal)? | cc0 | creativecommons org publicdomain zero
pddl-1.0 | public domain {dedication} and licen[cs]e(?: <1.0>)? | pddl 1 0 | opendatacommons org licenses pddl(?: 1 0)?
odbl-1.0 | open {database} licen[cs]e(?: <1.0>)? | odbl 1 0 | opendatacommons org licenses odbl(?: 1 0)?
odc-by-1.0 | open data {commons} attribution licen[cs]e(?: <1.0>)? | odc by 1 0 | opendatacommons org licenses by(?: 1 0)?
cc-by-nc-nd-4.0 | creative {commons} attribution (?:noncommercial|non commercial) (?:noderivatives|no derivatives|noderivs) <4.0> | cc by nc nd 4 0 | creativecommons org licenses by nc nd 4 0
cc-by-nc-sa-4.0 | creative {commons} attribution (?:noncommercial|non commercial) (?:sharealike|share alike) <4.0> | cc by nc sa 4 0 | creativecommons org licenses by nc sa 4 0
cc-by-nc-4.0 | creative {commons} attribution (?:noncommercial|non commercial) <4.0> | cc by nc 4 0 | creativecommons org licenses by nc 4 0
cc-by-nc-nd-4.0 | {cc} by nc nd <4.0> | cc by nc nd 4 0 | creativecommons org licenses by nc nd 4 0 (?:deed|legalcode)
cc-by-nc-nd-3.0 | {cc} by nc nd <3.0> | cc by nc nd 3 0 | creativecommons org licenses by nc nd 3 0
cc-by-nc-nd-2.5 | {cc} by nc nd <2.5> | cc by nc nd 2 5 | creativecommons org licenses by nc nd 2 5
cc-by-nc-nd-2.0 | {cc} by nc nd <2.0> | cc by nc nd 2 0 | creativecommons org licenses by nc nd 2 0
cc-by-nc-nd-1.0 | {cc} by nc nd (?:version |v ?)?1 0 | cc by nc nd 1 0 | creativecommons org licenses by (?:nc nd|nd nc) 1 0
cc-by-nc-sa-4.0 | {cc} by nc sa <4.0> | cc by nc sa 4 0 | creativecommons org licenses by nc sa 4 0 (?:deed|legalcode)
cc-by-nc-sa-3.0 | {cc} by nc sa <3.0> | cc by nc sa 3 0 | creativecommons org licenses by nc sa 3 0
cc-by-nc-sa-2.5 | {cc} by nc sa <2.5> | cc by nc sa 2 5 | creativecommons org licenses by nc sa 2 5
cc-by-nc-sa-2.0 | {cc} by nc sa <2.0> | cc by nc sa 2 0 | creativecommons org licenses by nc sa 2 0
cc-by-nc-sa-1.0 | {cc} by nc sa (?:version |v ?)?1 0 | cc by nc sa 1 0 | creativecommons org licenses by nc sa 1 0
cc-by-nc-4.0 | {cc} by nc <4.0> | cc by nc 4 0 | creativecommons org licenses by nc 4 0 (?:deed|legalcode)
cc-by-nc-3.0 | {cc} by nc <3.0> | cc by nc 3 0 | creativecommons org licenses by nc 3 0
cc-by-nc-2.5 | {cc} by nc <2.5> | cc by nc 2 5 | creativecommons org licenses by nc 2 5
cc-by-nc-2.0 | {cc} by nc <2.0> | cc by nc 2 0 | creativecommons org licenses by nc 2 0
cc-by-nc-1.0 | {cc} by nc (?:version |v ?)?1 0 | cc by nc 1 0 | creativecommons org licenses by nc 1 0
cc-by-nd-4.0 | {cc} by nd <4.0> | cc by nd 4 0 | creativecommons org licenses by nd 4 0
cc-by-nd-3.0 | {cc} by nd <3.0> | cc by nd 3 0 | creativecommons org licenses by nd 3 0
cc-by-nd-2.5 | {cc} by nd <2.5> | cc by nd 2 5 | creativecommons org licenses by nd 2 5
cc-by-nd-2.0 | {cc} by nd <2.0> | cc by nd 2 0 | creativecommons org licenses by nd 2 0
cc-by-nd-1.0 | {cc} by nd (?:version |v ?)?1 0 | cc by nd 1 0 | creativecommons org licenses by nd 1 0
cc-by-sa-4.0 | {cc} by sa <4.0> | cc by sa 4 0 | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | {cc} by sa <3.0> | cc by sa 3 0 | creativecommons org licenses by sa 3 0
cc-by-sa-2.5 | {cc} by sa <2.5> | cc by sa 2 5 | creativecommons org licenses by sa 2 5
cc-by-sa-2.0 | {cc} by sa <2.0> | cc by sa 2 0 | creativecommons org licenses by sa 2 0
cc-by-sa-1.0 | {cc} by sa (?:version |v ?)?1 0 | cc by sa 1 0 | creativecommons org licenses by sa 1 0
cc-by-4.0 | {cc} by <4.0> | cc by 4 0 | creativecommons org licenses by 4 0
cc-by-3.0 | {cc} by <3.0> | cc by 3 0 | creativecommons org licenses by 3 0
cc-by-2.5 | {cc} by <2.5> | cc by 2 5 | creativecommons org licenses by 2 5
cc-by-2.0 | {cc} by <2.0> | cc by 2 0 | creativecommons org licenses by 2 0
cc-by-1.0 | {cc} by (?:version |v ?)?1 0 | cc by 1 0 | creativecommons org licenses by 1 0
cc-by-4.0 | creative {commons} attribution <4.0>(?: international)? | cc by 4 0 | creativecommons org licenses by 4 0 (?:deed|legalcode)
cc-by-nc-nd | {cc} by nc nd | cc by nc nd | creativecommons org licenses by nc nd
cc-by-nc-sa | {cc} by nc sa | cc by nc sa | creativecommons org licenses by nc sa
cc-by-nc | {cc} by nc | cc by nc | creativecommons org licenses by nc
cc-by-nd | {cc} by nd | cc by nd | creativecommons org licenses by nd
cc-by-sa | creative {commons} attribution (?:sharealike|share alike)(?: <4.0>)?(?: international)? | cc by sa | creativecommons org licenses by sa
cc-by | creative {commons} attribution licen[cs]e | cc by(?! (?:nc|nd|sa|\d \d)(?= )) | creativecommons org licenses by(?! (?:nc|nd|sa|\d \d)(?= ))
cc | creative {commons} licen[cs]e | licenseref cc | creativecommons org licenses
ofl-1.1 | sil open {font} licen[cs]e(?: <1.1>)? | ofl 1 1(?: rfn| no rfn)? | scripts sil org ofl
ms-pl | {microsoft} public licen[cs]e | ms pl | opensource org licen[cs]es? ms pl(?: html)?
ms-rl | {microsoft} reciprocal licen[cs]e | ms rl | opensource org licen[cs]es? ms rl(?: html)?
python-2.0 | {python} software foundation licen[cs]e(?: <2.0>)? | (?:python|psf) 2 0 | docs python org 3 license(?: html)?
php-3.01 | {php} licen[cs]e(?: <3.01>)? | php 3 01 | php net license 3 01(?: txt)?
ruby | {ruby} licen[cs]e | ruby | ruby lang org en about license(?: txt)?
ncsa | university of illinois {ncsa} open source licen[cs]e | ncsa | otm illinois edu uiuc opensource
openssl | {openssl} licen[cs]e | openssl | openssl org source license(?: html)?
postgresql | {postgresql} licen[cs]e | postgresql | postgresql org about licence
afl-3.0 | {academic} free licen[cs]e(?: <3.0>)? | afl 3 0 | opensource org licenses afl 3 0(?: php)?
osl-3.0 | {open} software licen[cs]e(?: <3.0>)? | osl 3 0 | opensource org licenses osl 3 0(?: php)?
sspl-1.0 | server {side} public licen[cs]e(?: <1.0>)? | sspl 1 0 | mongodb com licensing server side public license
elastic-2.0 | {elastic} licen[cs]e(?: <2.0>)? | elastic 2 0 | elastic co licensing elastic license
json | {software} shall be used for good not evil | json | json org license(?: html)?
upl-1.0 | {universal} permissive licen[cs]e(?: <1.0>)? | upl 1 0 | opensource org licen[cs]es? upl
mulan-2.0 | {mulan} (?:psl|permissive software licen[cs]e)(?: <2.0>)? | mulanpsl 2 0 | license coscl org cn mulanpsl2
blueoak-1.0.0 | {blue} oak model licen[cs]e(?: 1 0 0)? | blueoak 1 0 0 | blueoakcouncil org license 1 0 0
public-domain | {dedicated} to the public domain | public domain | creativecommons org publicdomain mark 1 0
public-domain | in the public {domain} | licenseref public domain | creativecommons org licenses publicdomain
proprietary | {all} rights reserved | licenseref proprietary | licenseref commercial
proprietary | {confidential} and proprietary | licenseref all rights reserved | licenseref confidential
"""

# Kinds of a rule with the certainty of what it finds; an earlier kind has priority.
SPDX, NOTICE, ADDRESS, NAME = ("spdx", 1.0), ("notice", 0.95), ("address", 0.9), ("name", 0.7)
_UNDER = r"(?:licen[cs]ed|released|distributed|available|published|provided|covered|redistributed)(?: to you)?(?: is)? (?:under|by)(?: the)?(?: terms of)?(?: the)? "


class Rule(NamedTuple):
    rank: int
    label: str
    keyword: str
    certainty: float
    regex: str


def _versions(pattern: str) -> str:
    def one(m: re.Match) -> str:
        major, minor = m[1].split(".")
        return rf"(?:version |v ?)?{major}" + (r"(?: 0)?" if minor == "0" else f" {minor}")

    return re.sub(r"<([\d.]+)>", one, pattern)


def rules() -> list[Rule]:
    """All rules, of highest priority first."""
    rows = [[part.strip() for part in line.split("|", 1)] for line in TABLE.strip().splitlines()]
    found: list[tuple[int, str, str, float, str]] = []
    for label, rest in rows:
        name, spdx, address = re.split(r" \| ", rest)
        keyword = re.search(r"\{(\w+)\}", name)[1]
        name = _versions(name.replace("{", "").replace("}", ""))
        start = address.split(" ", 1)[0]
        found += [
            (0, label, "spdx", SPDX[1], f"spdx license identifiers? {spdx}"),
            (1, label, keyword, NOTICE[1], f"{_UNDER}(?:{name})"),
            (2, label, start, ADDRESS[1], address),
            (3, label, keyword, NAME[1], name),
        ]
    ordered = sorted(found, key=lambda r: r[0])
    return [Rule(i, label, keyword, certainty, rf"(?<= )(?:{regex})(?= )") for i, (_, label, keyword, certainty, regex) in enumerate(ordered)]
