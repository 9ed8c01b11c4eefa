"""Signature rules for licence texts.

Patterns are matched on the words of a text, lower-case and joined by one blank, so
``2.0`` reads ``2 0``. Each rule has keywords, and every match holds one of them.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str
    pattern: str
    base: bool = False

    @property
    def keywords(self) -> tuple[str, ...]:
        """The stretches of which every match holds one; ``keyword`` names them between slashes."""
        return tuple(self.keyword.split(" / "))


# Label | SPDX words | keywords of the name | pattern of the name | page, as words.
LICENCES = """
mit | mit | mit / expat | (?:expat|mit(?: x11| expat)?)(?: open source)? licen[cs]e | opensource org licenses? mit
mit-0 | mit 0 | mit | mit(?: no attribution| 0)(?: licen[cs]e)? | opensource org licenses? mit 0
apache-2.0 | apache 2 0 | apache | apache(?: software)? licen[cs]e(?: version| v)? 2(?: 0)? | apache org licenses license 2 0
apache-1.1 | apache 1 1 | apache | apache(?: software)? licen[cs]e(?: version| v)? 1 1 | apache org licenses license 1 1
apache | apache | apache | apache(?: software)? licen[cs]e | www apache org licenses
bsd-2-clause | bsd 2 clause | bsd | (?:bsd 2 clause|simplified bsd|2 clause bsd|freebsd)(?: licen[cs]e)? | opensource org licenses? bsd 2 clause
bsd-3-clause | bsd 3 clause | bsd | (?:bsd 3 clause|new bsd|modified bsd|revised bsd|3 clause bsd)(?: licen[cs]e)? | opensource org licenses? bsd 3 clause
bsd-4-clause | bsd 4 clause | bsd | (?:bsd 4 clause|original bsd|old bsd|4 clause bsd)(?: licen[cs]e)? | directory fsf org wiki license bsd 4clause
bsd | bsd | bsd | bsd(?: style| type)? licen[cs]e | opensource org licenses? bsd license
0bsd | 0bsd | bsd | (?:0bsd|zero clause bsd|bsd zero clause)(?: licen[cs]e)? | opensource org licenses? 0bsd
isc | isc | isc | isc licen[cs]e | opensource org licenses? isc
zlib | zlib | zlib | zlib(?: libpng)? licen[cs]e | opensource org licenses? zlib
libpng | libpng | libpng / png reference library | (?:libpng|png reference library) licen[cs]e | www libpng org pub png src libpng license
boost-1.0 | bsl 1 0 | boost | boost software licen[cs]e(?: version)?(?: 1 0)? | www boost org license 1 0
unlicense | unlicense | unlicense | (?:the )?unlicense | unlicense org
wtfpl | wtfpl | wtfpl | wtfpl(?: version 2)? | www wtfpl net
gpl-1.0 | gpl 1 0(?: only| or later)? | general public license | (?:gnu )?general public license(?: as published by the free software foundation)?(?: either)?(?: version| v) 1(?: 0)? | gnu org licenses(?: old licenses)? gpl 1 0
gpl-2.0 | gpl 2 0(?: only| or later)? | general public license | (?:gnu )?general public license(?: as published by the free software foundation)?(?: either)?(?: version| v) 2(?: 0)? | gnu org licenses(?: old licenses)? gpl 2 0
gpl-3.0 | gpl 3 0(?: only| or later)? | general public license | (?:gnu )?general public license(?: as published by the free software foundation)?(?: either)?(?: version| v) 3(?: 0)? | gnu org licenses gpl 3 0
gpl-2.0-short | gpl 2(?: 0)? | gpl | (?:gnu )?gpl(?: version| v)? ?2(?: 0)? | gnu org licenses gpl2
gpl-3.0-short | gpl 3(?: 0)? | gpl | (?:gnu )?gpl(?: version| v)? ?3(?: 0)? | gnu org licenses gpl3
lgpl-2.0 | lgpl 2 0(?: only| or later)? | general public license | (?:gnu )?library general public license(?: version| v)?(?: 2(?: 0)?)? | gnu org licenses(?: old licenses)? lgpl 2 0
lgpl-2.1 | lgpl 2 1(?: only| or later)? | general public license | (?:gnu )?lesser general public license(?: version| v) 2 1 | gnu org licenses(?: old licenses)? lgpl 2 1
lgpl-3.0 | lgpl 3 0(?: only| or later)? | general public license | (?:gnu )?lesser general public license(?: version| v) 3(?: 0)? | gnu org licenses lgpl 3 0
lgpl | lgpl | general public license | (?:gnu )?lesser general public license | www gnu org licenses lgpl
agpl-3.0 | agpl 3 0(?: only| or later)? | general public license | (?:gnu )?affero general public license(?:(?: version| v) 3(?: 0)?)? | gnu org licenses agpl 3 0
gfdl-1.2 | gfdl 1 2(?: only| or later)? | free documentation | (?:gnu )?free documentation license(?: version| v) 1 2 | gnu org licenses(?: old licenses)? fdl 1 2
gfdl-1.3 | gfdl 1 3(?: only| or later)? | free documentation | (?:gnu )?free documentation license(?: version| v) 1 3 | gnu org licenses fdl 1 3
gfdl | gfdl | free documentation | (?:gnu )?free documentation license | www gnu org copyleft fdl
mpl-1.1 | mpl 1 1 | mozilla | mozilla public license(?: version| v)? 1 1 | mozilla org mpl mpl 1 1
mpl-2.0 | mpl 2 0 | mozilla | mozilla public license(?: version| v)? 2(?: 0)? | mozilla org mpl 2 0
mpl | mpl | mozilla | mozilla public license | www mozilla org mpl
epl-1.0 | epl 1 0 | eclipse | eclipse public license(?: version| v)? 1(?: 0)? | eclipse org legal epl v10
epl-2.0 | epl 2 0 | eclipse | eclipse public license(?: version| v)? 2(?: 0)? | eclipse org legal epl 2 0
edl-1.0 | edl 1 0 | eclipse | eclipse distribution license(?: version| v)?(?: 1(?: 0)?)? | eclipse org org documents edl v10
cpl-1.0 | cpl 1 0 | common public | common public license(?: version| v)?(?: 1(?: 0)?)? | opensource org licenses? cpl1 0
cddl-1.0 | cddl 1 0 | common development | common development and distribution license(?: cddl)?(?: version| v)?(?: 1 0)? | opensource org licenses? cddl1
cddl-1.1 | cddl 1 1 | common development | common development and distribution license(?: cddl)?(?: version| v)? 1 1 | glassfish java net public cddl gpl 1 1
eupl-1.1 | eupl 1 1 | european union | european union public licen[cs]e(?: version| v)? 1 1 | joinup ec europa eu software page eupl licence eupl
eupl-1.2 | eupl 1 2 | european union | european union public licen[cs]e(?: version| v)? 1 2 | joinup ec europa eu collection eupl eupl text eupl 1 2
artistic-1.0 | artistic 1 0 | artistic | (?:perl )?artistic license(?: version| v)? 1(?: 0)? | opensource org licenses? artistic 1 0
artistic-2.0 | artistic 2 0 | artistic | (?:perl )?artistic license(?: version| v)? 2(?: 0)? | opensource org licenses? artistic 2 0
artistic | artistic | artistic | (?:perl )?artistic license | www perlfoundation org artistic license
python-2.0 | python 2 0 | python | python(?: software foundation)? license(?: version| v)?(?: 2)? | www python org download releases license
psf-2.0 | psf 2 0 | psf | psf license(?: agreement)? | docs python org license
php-3.01 | php 3 01 | php | php license(?: version| v)?(?: 3 01?)? | www php net license 3 01
postgresql | postgresql | postgresql | postgresql licen[cs]e | opensource org licenses? postgresql
openssl | openssl | openssl | openssl(?: and ssleay)? licen[cs]e | www openssl org source license
ofl-1.1 | ofl 1 1 | open font | (?:sil )?open font license(?: version| v)?(?: 1 1)? | scripts sil org ofl
ncsa | ncsa | ncsa | (?:university of illinois )?ncsa(?: open source)? license | opensource org licenses? ncsa
upl-1.0 | upl 1 0 | universal permissive | universal permissive license(?: version| v)?(?: 1 0)? | oss oracle com licenses upl
ms-pl | ms pl | microsoft | microsoft public license(?: ms pl)? | opensource org licenses? ms pl
ms-rl | ms rl | microsoft | microsoft reciprocal license(?: ms rl)? | opensource org licenses? ms rl
afl-3.0 | afl 3 0 | academic free | academic free license(?: version| v)?(?: 3 0)? | opensource org licenses? afl 3 0
osl-3.0 | osl 3 0 | open software | open software license(?: version| v)?(?: 3 0)? | opensource org licenses? osl 3 0
bsl-1.1 | busl 1 1 | business source | business source license(?: version| v)?(?: 1 1)? | mariadb com bsl11
sspl-1.0 | sspl 1 0 | server side public | server side public license(?: version| v)?(?: 1)? | www mongodb com licensing server side public license
elastic-2.0 | elastic 2 0 | elastic | elastic license(?: version| v)?(?: 2 0)? | www elastic co licensing elastic license
cc0-1.0 | cc0 1 0 | cc0 | cc0(?: 1 0)?(?: universal)?(?: public domain dedication)? | creativecommons org publicdomain zero 1 0
cc-pdm | cc pdm(?: 1 0)? | public domain mark | (?:creative commons )?public domain mark(?: 1 0)? | creativecommons org publicdomain mark 1 0
cc-by-nc-nd | cc by nc nd(?: [1-4] [05])? | cc by nc nd | cc by nc nd(?: [1-4] [05])? | creativecommons org licenses by nc nd
cc-by-nc-sa | cc by nc sa(?: [1-4] [05])? | cc by nc sa | cc by nc sa(?: [1-4] [05])? | creativecommons org licenses by nc sa
cc-by-nc | cc by nc(?: [1-4] [05])? | cc by nc | cc by nc(?: [1-4] [05])? | creativecommons org licenses by nc
cc-by-nd | cc by nd(?: [1-4] [05])? | cc by nd | cc by nd(?: [1-4] [05])? | creativecommons org licenses by nd
cc-by-sa | cc by sa(?: [1-4] [05])? | cc by sa | cc by sa(?: [1-4] [05])? | creativecommons org licenses by sa
cc-by-4.0 | cc by 4 0 | cc by | cc by 4 0 | creativecommons org licenses by 4 0
cc-by-3.0 | cc by 3 0 | cc by | cc by 3 0 | creativecommons org licenses by 3 0
odbl-1.0 | odbl 1 0 | open database | open database license(?: odbl)?(?: version| v)?(?: 1 0)? | opendatacommons org licenses odbl
odc-by | odc by(?: 1 0)? | attribution license | open data commons attribution license(?: odc by)?(?: version| v)?(?: 1 0)? | opendatacommons org licenses by
pddl-1.0 | pddl 1 0 | public domain dedication | (?:open data commons )?public domain dedication and license(?: pddl)? | opendatacommons org licenses pddl
ogl-uk | ogl uk(?: [1-3] 0)? | open government | open government licen[cs]e(?: version| v)?(?: [1-3](?: 0)?)? | nationalarchives gov uk doc open government licence
openrail | openrail | openrail / open rail | (?:creativeml |bigscience |bigcode )?open ?rail(?: m| plus plus m)?(?: licen[cs]e)? | www licenses ai ai licenses
llgpl | llgpl | llgpl / lisp lesser | (?:lisp lesser general public license|llgpl) | opensource franz com preamble
vim | vim | vim | vim licen[cs]e | vimdoc sourceforge net htmldoc uganda
ruby | ruby | ruby | ruby licen[cs]e | www ruby lang org en about license
curl | curl | curl | curl licen[cs]e | curl se docs copyright
w3c | w3c | w3c | w3c(?: software(?: notice)?(?: and)?(?: document)?)? licen[cs]e | www w3 org consortium legal
unicode-dfs | unicode dfs(?: 201[56])? | unicode | unicode(?: inc)? licen[cs]e agreement | www unicode org copyright
zpl-2.1 | zpl 2 1 | zope | zope public license(?: version| v)?(?: 2 1)? | old zope dev resources license zpl 2 1
cecill-2.1 | cecill 2 1 | cecill | cecill(?: free software)?(?: license)?(?: agreement)?(?: version| v)?(?: 2(?: 1)?)? | www cecill info licences
mulan-2.0 | mulanpsl 2 0 | mulan | mulan(?: permissive software license| psl)(?: version| v)?(?: 2)? | license coscl org cn mulanpsl2
beerware | beerware | beer | (?:the )?beer ?ware licen[cs]e | people freebsd org phk
"""

# Label | priority | keyword | pattern, for phrases that name no licence by its title.
PHRASES = """
cc-by-nc-nd | 70 | creative commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?
cc-by-nc-sa | 70 | creative commons | creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?
cc-by-nc | 70 | creative commons | creative commons attribution non ?commercial(?: [1-4] [05])?
cc-by-nd | 70 | creative commons | creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?
cc-by-sa | 70 | creative commons | creative commons attribution share ?alike(?: [1-4] [05])?
creative-commons | 60 | creative commons | creative commons attribution(?: [1-4] [05])?
creative-commons | 40 | creative commons | creative commons(?: licen[cs]ed?)?
mit | 85 | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy
mit | 60 | without restriction | to deal in the software without restriction
bsd | 85 | redistribution and use | redistribution and use in source and binary forms(?: with or without modification)?
bsd-3-clause | 86 | neither the name | neither the names? of .{1,80} nor the names of (?:its|his|their) contributors
isc | 85 | permission to use | permission to use copy modify and or distribute this software for any purpose
zlib | 85 | provided as is | this software is provided as is without any express or implied warranty in no event
boost-1.0 | 85 | free of charge to any person | free of charge to any person or organization obtaining a copy
unlicense | 85 | public domain | free and unencumbered software released into the public domain
public-domain | 60 | public domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | 40 | public domain | (?:in )?the public domain
gpl | 65 | free software | this program is free software
gpl | 66 | redistribute it | you can redistribute it and or modify it under the terms of the gnu general public license
gpl | 40 | gpl | gnu gpl|gpl licen[cs]ed?
gpl | 45 | copyleft | copyleft licen[cs]e
no-warranty | 30 | warranty | without warranty of any kind
no-warranty | 30 | warranty | without any warranty
no-warranty | 31 | merchantability | warrant(?:y|ies) of merchantability(?: and| or)? fitness for a particular purpose
copyright | 25 | copyright | copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)?[0-9][0-9])?
copyright | 20 | copyright | copyright (?:c|by|notice|holders?)
copyright | 15 | copyrighted | (?:is |are )?copyrighted(?: material| work)?
proprietary | 55 | proprietary | proprietary and confidential
proprietary | 54 | confidential | confidential (?:and proprietary )?information
proprietary | 50 | unauthorized | unauthorized (?:copying|use|reproduction|distribution)
proprietary | 50 | prior written | without (?:the )?(?:express )?prior written (?:permission|consent)
proprietary | 50 | may not be | may not be (?:reproduced|copied|redistributed|published|distributed)
non-commercial | 48 | non commercial | (?:for )?non commercial (?:use|purposes)(?: only)?
non-commercial | 48 | noncommercial | (?:for )?noncommercial (?:use|purposes)(?: only)?
research-only | 48 | research | (?:for )?(?:academic )?research (?:use|purposes) only
personal-use | 48 | personal use | (?:for )?personal use only
fair-use | 40 | fair use | (?:under )?fair use(?: doctrine)?
spdx | 35 | spdx | spdx license identifier
rights-granted | 30 | royalty free | royalty free licen[cs]e
rights-granted | 30 | perpetual | perpetual worldwide non exclusive
open-source | 28 | open source | open source licen[cs]ed?
free-software | 28 | free software | free software licen[cs]ed?
licence-file | 22 | see the | see the licen[cs]e(?: file)?(?: for)?
licence-file | 22 | license file | license file
licensed | 10 | licensed under | (?:is |are )?licensed under
licensed | 10 | released under | (?:is |are )?released under
terms-of-use | 26 | terms of | terms of (?:use|service)
eula | 52 | end user | end user licen[cs]e agreement
trademark | 18 | trademark | (?:registered )?trademarks? of
dual-licence | 42 | dual licen | dual licen[cs](?:ed|ing)
"""

# Phrase and label of the rules that every scan reports.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

GRANT = "(?:licensed|released|distributed|published|available|covered|governed|provided) (?:under|by)" \
        "(?: the)?(?: terms(?: and conditions)? of)?(?: the)? "


def rules() -> tuple[Rule, ...]:
    """All rules, in order: base phrases, then each licence's tag, page, grant and name, then phrases."""
    found = [Rule(label, 1, phrase, phrase, base=True) for phrase, label in BASE]
    for line in LICENCES.strip().splitlines():
        label, tag, keyword, name, page = (part.strip() for part in line.split(" | "))
        label = label.removesuffix("-short")
        found += [
            Rule(label, 100, "spdx license identifier", f"spdx license identifier {tag}"),
            Rule(label, 90, page.split("(?:")[0].split("s?")[0].strip(), f"{page}"),
            Rule(label, 80, keyword, f"{GRANT}(?:{name})"),
            Rule(label, 50, keyword, name),
        ]
    for line in PHRASES.strip().splitlines():
        label, priority, keyword, pattern = (part.strip() for part in line.split(" | ", 3))
        found.append(Rule(label, int(priority), keyword, f"(?:{pattern})"))
    return tuple(found)
