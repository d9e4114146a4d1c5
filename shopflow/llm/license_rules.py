"""Signature rules for license scans: ``label | level | keyword | pattern``, in order of priority within a level.

A pattern is a regular expression over a text's words (lower case, one space between words, punctuation
gone: ``CC BY-NC 4.0`` is ``cc by nc 4 0``); it begins and ends at word borders.  The keyword is a word that
every match holds; a text without it is not searched for the rule.  Levels: 1 wording of a license or its
notice, 2 named license with its version or identifier, 3 named license without version, 4 mention of a kind.
"""

from __future__ import annotations

from dataclasses import dataclass

BASE = ("mit | 3 | mit | mit license", "apache | 3 | apache | apache license",
        "gpl | 3 | general | general public license")

RULES = r"""
mit | 1 | charge | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 1 | sublicense | without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software
mit | 1 | substantial | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
x11 | 1 | consortium | except as contained in this notice the name of the x consortium shall not be used in advertising
mit-0 | 1 | deal | deal in the software without restriction (?:\S+ ){0,20}persons to whom the software is furnished to do so
as-is | 1 | noninfringement | the software is provided as is without warranty of any kind (?:\S+ ){0,20}noninfringement
isc | 1 | fee | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
0bsd | 1 | fee | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software
isc | 1 | isc | the isc license(?: isc)? copyright
hpnd | 1 | fee | permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted
bsd | 1 | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd | 1 | redistributions | redistributions of source code must retain the above copyright notice
bsd | 1 | redistributions | redistributions in binary form must reproduce the above copyright notice
bsd-3-clause | 1 | endorse | neither the name of (?:\S+ ){1,12}nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | 1 | advertising | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
apache-2.0 | 1 | apache | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0 | 1 | unless | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0 | 1 | apache | www apache org licenses license 2 0
apache-1.1 | 1 | apache | this product includes software developed by the apache software foundation
gpl-1.0 | 1 | version | under the terms of the gnu general public license as published by the free software foundation either version 1
gpl-2.0-or-later | 1 | version | under the terms of the gnu general public license as published by the free software foundation either version 2 (?:of the license )?or at your option any later version
gpl-3.0-or-later | 1 | version | under the terms of the gnu general public license as published by the free software foundation either version 3 (?:of the license )?or at your option any later version
gpl-2.0-only | 1 | version | under the terms of the gnu general public license version 2 (?:only )?as published by the free software foundation
gpl-3.0-only | 1 | version | under the terms of the gnu general public license version 3 (?:only )?as published by the free software foundation
lgpl-2.0-or-later | 1 | library | under the terms of the gnu library general public license as published by the free software foundation either version 2
lgpl-2.1-or-later | 1 | lesser | under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 (?:of the license )?or at your option any later version
lgpl-3.0-or-later | 1 | lesser | under the terms of the gnu lesser general public license as published by the free software foundation either version 3 (?:of the license )?or at your option any later version
agpl-3.0-or-later | 1 | affero | under the terms of the gnu affero general public license as published by the free software foundation either version 3 (?:of the license )?or at your option any later version
gpl | 1 | fitness | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu (?:\S+ ){0,2}general public license for more details
gpl | 1 | everyone | everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed
gpl | 1 | received | you should have received a copy of the gnu (?:\S+ ){0,2}general public license along with this (?:program|library|file)
gpl-3.0 | 1 | copyleft | the gnu general public license is a free copyleft license for software and other kinds of works
agpl-3.0 | 1 | copyleft | the gnu affero general public license is a free copyleft license for software and other kinds of works
gfdl | 1 | documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl | 1 | invariant | with no invariant sections no front cover texts and no back cover texts
mpl-2.0 | 1 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | 1 | mpl | if a copy of the mpl was not distributed with this file you can obtain one at
mpl-1.1 | 1 | mozilla | the contents of this file are subject to the mozilla public license version 1 1
mpl-1.0 | 1 | mozilla | the contents of this file are subject to the mozilla public license version 1 0
npl-1.1 | 1 | netscape | the contents of this file are subject to the netscape public license version 1 1
cddl-1.0 | 1 | distribution | the contents of this file are subject to the terms of the common development and distribution license
epl-1.0 | 1 | eclipse | made available under the terms of the eclipse public license v(?:ersion)? ?1 0
epl-2.0 | 1 | eclipse | made available under the terms of the eclipse public license (?:v 2 0|2 0|v2 0|version 2 0)
eupl-1.2 | 1 | eupl | licensed under the eupl version 1 2
unlicense | 1 | unencumbered | this is free and unencumbered software released into the public domain
unlicense | 1 | anyone | anyone is free to copy modify publish use compile sell or distribute this software
cc0-1.0 | 1 | dedicated | (?:has|have) dedicated (?:\S+ ){1,6}to the public domain (?:\S+ ){0,8}waiving all (?:of )?(?:his|her|their) rights
cc0-1.0 | 1 | waived | to the extent possible under law (?:\S+ ){1,12}has waived all copyright and related or neighbou?ring rights
wtfpl | 1 | fuck | do what the fuck you want to public license
wtfpl | 1 | fuck | you just do what the fuck you want to
zlib | 1 | altered | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib | 1 | damages | in no event will the authors be held liable for any damages arising from the use of this software
zlib | 1 | misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software
bsl-1.0 | 1 | boost | distributed under the boost software license version 1 0
bsl-1.0 | 1 | charge | permission is hereby granted free of charge to any person or organization obtaining a copy of the software
artistic-1.0 | 1 | intent | the intent of this document is to state the conditions under which a package may be copied
artistic-2.0 | 1 | artistic | the artistic license 2 0 copyright
perl | 1 | perl | under the same terms as perl(?: 5| itself)?
python-2.0 | 1 | python | psf is making python available to licensee on an as is basis
ofl-1.1 | 1 | font | this font software is licensed under the sil open font license version 1 1
ms-pl | 1 | accompanying | this license governs use of the accompanying software if you use the software you accept this license
beerware | 1 | beer | you can buy me a beer in return
json | 1 | evil | the software shall be used for good not evil
postgresql | 1 | postgresql | postgresql is released under the postgresql license
ncsa | 1 | illinois | university of illinois ncsa open source license
curl | 1 | curl | copyright and permission notice (?:\S+ ){0,12}curl
openssl | 1 | openssl | this product includes software developed by the openssl project
ssleay | 1 | cryptographic | this product includes cryptographic software written by eric young
php-3.01 | 1 | php | this product includes php software freely available from
vim | 1 | vim | vim is charityware
ibm-pibs | 1 | ibm | this source code has been made available to you by ibm on an as is basis
elastic-2.0 | 1 | managed | you may not provide the software to third parties as a hosted or managed service
busl-1.1 | 1 | production | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use
commons-clause | 1 | sell | the license does not grant to you the right to sell the software
sspl-1.0 | 1 | server | server side public license version 1
cc-by | 1 | creative | this work is licensed under (?:a|the) creative commons attribution license
cc-by-sa | 1 | creative | this work is licensed under (?:a|the) creative commons attribution share ?alike
proprietary | 1 | rights | all rights reserved (?:\S+ ){0,6}no part of this (?:publication|work|book|document) may be reproduced
proprietary | 1 | confidential | confidential and proprietary(?: information)?
proprietary | 1 | unauthorized | unauthorized (?:copying|use|reproduction|distribution) (?:\S+ ){0,8}strictly prohibited
noncommercial | 1 | commercial | may not be used for commercial purposes
noncommercial | 1 | noncommercial | for noncommercial (?:use|purposes) only
mit | 2 | spdx | spdx license identifier mit
mit-0 | 2 | mit | (?:mit no attribution|spdx license identifier mit 0)
mit | 2 | licenses | opensource org licenses mit(?: license)?(?: php| html)?
mit | 2 | expat | expat (?:mit )?license
mit | 2 | mit | mit x11 license
mit | 2 | mit | (?:released|licensed|distributed|available) under (?:the )?(?:terms of )?(?:the )?mit license
mit | 2 | mit | (?:released|licensed|distributed|available) under (?:the )?mit
isc | 2 | spdx | spdx license identifier isc
isc | 2 | isc | (?:released|licensed|distributed) under (?:the )?isc license
0bsd | 2 | 0bsd | (?:spdx license identifier )?0bsd
bsd-2-clause | 2 | bsd | bsd 2 clause(?: simplified)?(?: license)?
bsd-2-clause | 2 | bsd | (?:simplified|freebsd) bsd license
bsd-2-clause | 2 | clause | (?:two|2) clause bsd(?: license)?
bsd-3-clause | 2 | bsd | bsd 3 clause(?: new| revised)?(?: license)?
bsd-3-clause | 2 | bsd | (?:new|revised|modified) bsd license
bsd-3-clause | 2 | clause | (?:three|3) clause bsd(?: license)?
bsd-4-clause | 2 | bsd | bsd 4 clause(?: license)?
bsd-4-clause | 2 | bsd | original bsd license
bsd-3-clause-clear | 2 | bsd | bsd 3 clause clear(?: license)?
bsd-2-clause-patent | 2 | bsd | bsd 2 clause (?:plus )?patent(?: license)?
bsd-3-clause | 2 | licenses | opensource org licenses bsd 3 clause
bsd-2-clause | 2 | licenses | opensource org licenses bsd 2 clause
apache-2.0 | 2 | apache | (?:licensed|released|distributed) under (?:the )?apache license(?: version)? (?:2 0|2|v2|v2 0)
apache-2.0 | 2 | apache | apache (?:software )?license (?:version |v )?(?:2 0|v2 0|v2|2)
apache-2.0 | 2 | spdx | spdx license identifier apache 2 0
apache-2.0 | 2 | apache | apache 2 0(?: license| licence)?
apache-2.0 | 2 | asl | asl 2 0
apache-2.0 | 2 | licenses | opensource org licenses apache 2 0
apache-1.1 | 2 | apache | apache (?:software )?license (?:version )?1 1
apache-1.0 | 2 | apache | apache (?:software )?license (?:version )?1 0
gpl-1.0 | 2 | gpl | gpl (?:version )?1 0(?: only| or later)?
gpl-2.0-only | 2 | spdx | spdx license identifier gpl 2 0(?: only)?
gpl-2.0-or-later | 2 | spdx | spdx license identifier gpl 2 0 (?:or later|plus)
gpl-3.0-only | 2 | spdx | spdx license identifier gpl 3 0(?: only)?
gpl-3.0-or-later | 2 | spdx | spdx license identifier gpl 3 0 (?:or later|plus)
gpl-2.0 | 2 | general | gnu general public license (?:gpl )?(?:version |v )?(?:2 0|2|v2|v2 0)
gpl-3.0 | 2 | general | gnu general public license (?:gpl )?(?:version |v )?(?:3 0|3|v3|v3 0)
gpl-3.0 | 2 | licensed | this work is licensed under the gnu general public license version 3
gpl-2.0 | 2 | gplv2 | (?:gnu )?gplv2(?: license)?
gpl-3.0 | 2 | gplv3 | (?:gnu )?gplv3(?: license)?
gpl-2.0 | 2 | gpl | (?:gnu )?gpl (?:version 2|v2|2 0|v 2)
gpl-3.0 | 2 | gpl | (?:gnu )?gpl (?:version 3|v3|3 0|v 3)
gpl | 2 | gnu | www gnu org licenses gpl(?: html| txt)?
gpl-2.0 | 2 | gnu | www gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt)?
gpl-3.0 | 2 | gnu | www gnu org licenses gpl 3 0(?: html| txt)?
gpl-2.0-with-classpath-exception | 2 | classpath | (?:gpl|gplv2|license) (?:\S+ ){0,4}with (?:the )?classpath exception
gpl-2.0-with-linking-exception | 2 | linking | gpl (?:\S+ ){0,4}with (?:the )?(?:\S+ )?linking exception
lgpl-2.0 | 2 | library | gnu library general public license (?:version |v )?(?:2 0|2|v2)
lgpl-2.1 | 2 | lesser | (?:gnu )?lesser general public license (?:lgpl )?(?:version |v )?(?:2 1|v2 1)
lgpl-3.0 | 2 | lesser | (?:gnu )?lesser general public license (?:lgpl )?(?:version |v )?(?:3 0|3|v3)
lgpl-2.1 | 2 | lgpl | lgpl (?:version |v )?(?:2 1|v2 1)
lgpl-3.0 | 2 | lgpl | lgpl (?:version |v )?(?:3 0|3|v3)
lgpl-2.1 | 2 | lgplv2 | lgplv2(?: 1)?
lgpl-3.0 | 2 | lgplv3 | lgplv3
lgpl-2.1 | 2 | spdx | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3.0 | 2 | spdx | spdx license identifier lgpl 3 0(?: only| or later)?
agpl-3.0 | 2 | affero | (?:gnu )?affero general public license (?:version |v )?(?:3 0|3|v3)
agpl-1.0 | 2 | affero | affero general public license (?:version |v )?(?:1 0|1|v1)
agpl-3.0 | 2 | agplv3 | (?:gnu )?agplv3
agpl-3.0 | 2 | agpl | (?:gnu )?agpl (?:version |v )?(?:3 0|3|v3)
agpl-3.0 | 2 | spdx | spdx license identifier agpl 3 0(?: only| or later)?
gfdl-1.3 | 2 | documentation | (?:gnu )?free documentation license (?:version |v )?1 3
gfdl-1.2 | 2 | documentation | (?:gnu )?free documentation license (?:version |v )?1 2
gfdl-1.1 | 2 | documentation | (?:gnu )?free documentation license (?:version |v )?1 1
mpl-2.0 | 2 | mozilla | mozilla public license (?:mpl )?(?:version |v )?(?:2 0|2|v2|v2 0)
mpl-1.1 | 2 | mozilla | mozilla public license (?:mpl )?(?:version |v )?(?:1 1|v1 1)
mpl-1.0 | 2 | mozilla | mozilla public license (?:mpl )?(?:version |v )?(?:1 0|v1 0)
mpl-2.0 | 2 | spdx | spdx license identifier mpl 2 0
mpl-2.0 | 2 | mpl | mpl (?:version |v )?(?:2 0|v2 0|v2)
mpl-1.1 | 2 | mpl | mpl (?:version |v )?(?:1 1|v1 1)
epl-1.0 | 2 | eclipse | eclipse public license (?:epl )?(?:version |v )?(?:1 0|1|v1 0)
epl-2.0 | 2 | eclipse | eclipse public license (?:epl )?(?:version |v )?(?:2 0|2|v2 0)
epl-2.0 | 2 | spdx | spdx license identifier epl 2 0
edl-1.0 | 2 | eclipse | eclipse distribution license (?:version |v )?(?:1 0|v1 0)
cddl-1.0 | 2 | cddl | cddl (?:version |v )?(?:1 0|v1 0)
cddl-1.1 | 2 | cddl | cddl (?:version |v )?(?:1 1|v1 1)
cpl-1.0 | 2 | common | common public license (?:version |v )?(?:1 0|v1 0)
ipl-1.0 | 2 | ibm | ibm public license (?:version |v )?(?:1 0|v1 0)
eupl-1.1 | 2 | eupl | eupl (?:version |v )?(?:1 1|v1 1)
eupl-1.2 | 2 | eupl | eupl (?:version |v )?(?:1 2|v1 2)
cecill-2.1 | 2 | cecill | cecill (?:version |v )?2 1
cecill-b | 2 | cecill | cecill b(?: license)?
cecill-c | 2 | cecill | cecill c(?: license)?
osl-3.0 | 2 | open | open software license (?:version |v )?(?:3 0|v3 0)
afl-3.0 | 2 | academic | academic free license (?:version |v )?(?:3 0|v3 0)
afl-2.1 | 2 | academic | academic free license (?:version |v )?(?:2 1|v2 1)
bsl-1.0 | 2 | boost | boost software license(?: version| v)? 1 0
bsl-1.0 | 2 | boost | www boost org licenses? 1 0 txt
artistic-2.0 | 2 | artistic | artistic license (?:version |v )?(?:2 0|v2 0|2)
artistic-1.0 | 2 | artistic | artistic license (?:version |v )?(?:1 0|v1 0)
python-2.0 | 2 | python | python (?:software foundation )?license (?:version |v )?2(?: 0)?
zpl-2.1 | 2 | zope | zope public license (?:version |v )?2 1
w3c | 2 | w3c | w3c software (?:notice )?(?:and )?license
unicode | 2 | unicode | unicode license (?:agreement|v3)
php-3.0 | 2 | php | php license (?:version |v )?3 0
php-3.01 | 2 | php | php license (?:version |v )?3 01
ofl-1.1 | 2 | ofl | (?:sil )?ofl (?:version |v )?1 1
ofl-1.1 | 2 | font | (?:sil )?open font license (?:version |v )?1 1
ms-pl | 2 | microsoft | microsoft public license(?: ms pl)?
ms-rl | 2 | microsoft | microsoft reciprocal license(?: ms rl)?
cc0-1.0 | 2 | cc0 | cc0 (?:1 0|v1 0)(?: universal)?
cc0-1.0 | 2 | publicdomain | creativecommons org publicdomain zero 1 0
cc-by-4.0 | 2 | cc | cc by (?:v ?)?4 0
cc-by-3.0 | 2 | cc | cc by (?:v ?)?3 0
cc-by-2.5 | 2 | cc | cc by (?:v ?)?2 5
cc-by-2.0 | 2 | cc | cc by (?:v ?)?2 0
cc-by-sa-4.0 | 2 | cc | cc by sa (?:v ?)?4 0
cc-by-sa-3.0 | 2 | cc | cc by sa (?:v ?)?3 0
cc-by-sa-2.0 | 2 | cc | cc by sa (?:v ?)?2 0
cc-by-nc-4.0 | 2 | cc | cc by nc (?:v ?)?4 0
cc-by-nc-3.0 | 2 | cc | cc by nc (?:v ?)?3 0
cc-by-nc-2.0 | 2 | cc | cc by nc (?:v ?)?2 0
cc-by-nd-4.0 | 2 | cc | cc by nd (?:v ?)?4 0
cc-by-nd-3.0 | 2 | cc | cc by nd (?:v ?)?3 0
cc-by-nc-sa-4.0 | 2 | cc | cc by nc sa (?:v ?)?4 0
cc-by-nc-sa-3.0 | 2 | cc | cc by nc sa (?:v ?)?3 0
cc-by-nc-nd-4.0 | 2 | cc | cc by nc nd (?:v ?)?4 0
cc-by-nc-nd-3.0 | 2 | cc | cc by nc nd (?:v ?)?3 0
cc-by-4.0 | 2 | attribution | creative commons attribution 4 0(?: international)?(?: license)?
cc-by-3.0 | 2 | attribution | creative commons attribution 3 0(?: unported)?(?: license)?
cc-by-sa-4.0 | 2 | attribution | creative commons attribution share ?alike 4 0(?: international)?(?: license)?
cc-by-sa-3.0 | 2 | attribution | creative commons attribution share ?alike 3 0(?: unported)?(?: license)?
cc-by-nc-4.0 | 2 | attribution | creative commons attribution non ?commercial 4 0(?: international)?(?: license)?
cc-by-nd-4.0 | 2 | attribution | creative commons attribution no ?deriv(?:ative)?s 4 0(?: international)?(?: license)?
cc-by-nc-sa-4.0 | 2 | attribution | creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: license)?
cc-by-nc-nd-4.0 | 2 | attribution | creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?(?: license)?
cc-by | 2 | creativecommons | creativecommons org licenses by \d \d
cc-by-sa | 2 | creativecommons | creativecommons org licenses by sa \d \d
cc-by-nc | 2 | creativecommons | creativecommons org licenses by nc \d \d
cc-by-nd | 2 | creativecommons | creativecommons org licenses by nd \d \d
cc-by-nc-sa | 2 | creativecommons | creativecommons org licenses by nc sa \d \d
cc-by-nc-nd | 2 | creativecommons | creativecommons org licenses by nc nd \d \d
odbl-1.0 | 2 | odbl | odbl (?:version |v )?1 0
odbl-1.0 | 2 | database | open (?:data commons )?(?:open )?database license(?: odbl)? (?:v ?)?1 0
odc-by-1.0 | 2 | commons | open data commons attribution license (?:v ?)?1 0
pddl-1.0 | 2 | dedication | public domain dedication and license (?:pddl )?(?:v ?)?1 0
ogl-uk-3.0 | 2 | government | open government licen[cs]e v?3 0
etalab-2.0 | 2 | etalab | etalab (?:open )?licen[cs]e 2 0
sspl-1.0 | 2 | sspl | sspl (?:version |v )?1(?: 0)?
busl-1.1 | 2 | business | business source license (?:version |v )?1 1
elastic-2.0 | 2 | elastic | elastic license (?:version |v )?(?:2 0|v2)
blueoak-1.0.0 | 2 | oak | blue oak model license 1 0 0
openrail | 2 | openrail | (?:creativeml )?openrail(?: m| plus)?(?: license)?
mit | 3 | licence | mit licence
mit | 3 | mit | mit (?:style|like) license
isc | 3 | isc | isc licen[cs]e
bsd | 3 | bsd | bsd (?:style |like )?licen[cs]e
apache | 3 | apache | apache licen[cs]e
apache | 3 | apache | apache software (?:foundation )?licen[cs]e
gpl | 3 | gnu | gnu (?:gpl|public licen[cs]e)
gpl | 3 | gpl | gpl(?: licen[cs]e| licensed)
gpl | 3 | general | gnu general public licen[cs]e
lgpl | 3 | lesser | (?:gnu )?lesser general public licen[cs]e
lgpl | 3 | library | (?:gnu )?library general public licen[cs]e
lgpl | 3 | lgpl | lgpl
agpl | 3 | affero | (?:gnu )?affero general public licen[cs]e
agpl | 3 | agpl | agpl
gfdl | 3 | documentation | (?:gnu )?free documentation licen[cs]e
gfdl | 3 | gfdl | gfdl
mpl | 3 | mozilla | mozilla public licen[cs]e
epl | 3 | eclipse | eclipse public licen[cs]e
cddl | 3 | cddl | cddl
cddl | 3 | distribution | common development and distribution licen[cs]e
eupl | 3 | eupl | eupl
eupl | 3 | european | european union public licen[cs]e
cecill | 3 | cecill | cecill(?: free software)?(?: licen[cs]e)?
bsl-1.0 | 3 | boost | boost (?:software )?licen[cs]e
artistic | 3 | artistic | artistic licen[cs]e
python | 3 | python | python (?:software foundation )?licen[cs]e
zlib | 3 | zlib | zlib(?: libpng)? licen[cs]e
unlicense | 3 | unlicense | (?:the )?unlicense
wtfpl | 3 | wtfpl | wtfpl
beerware | 3 | beerware | beerware(?: licen[cs]e)?
ofl | 3 | font | (?:sil )?open font licen[cs]e
cc0 | 3 | cc0 | cc0(?: licen[cs]e)?
cc-by | 3 | cc | cc by
cc-by-sa | 3 | cc | cc by sa
cc-by-nc | 3 | cc | cc by nc
cc-by-nd | 3 | cc | cc by nd
cc-by-nc-sa | 3 | cc | cc by nc sa
cc-by-nc-nd | 3 | cc | cc by nc nd
cc-by | 3 | attribution | creative commons attribution(?: licen[cs]e)?
cc | 3 | creative | creative commons(?: licen[cs]e| licensed)?
odbl | 3 | odbl | odbl
odbl | 3 | database | open (?:data commons )?(?:open )?database licen[cs]e
sspl | 3 | server | server side public licen[cs]e
busl | 3 | business | business source licen[cs]e
elastic | 3 | elastic | elastic licen[cs]e
commons-clause | 3 | clause | commons clause
vim | 3 | vim | vim licen[cs]e
openssl | 3 | openssl | openssl licen[cs]e
ncsa | 3 | ncsa | ncsa (?:open source )?licen[cs]e
postgresql | 3 | postgresql | postgresql licen[cs]e
ms-pl | 3 | pl | ms pl
proprietary | 3 | proprietary | proprietary licen[cs]e
public-domain | 4 | domain | (?:released |placed )?(?:in(?:to)? )?the public domain
permissive | 4 | permissive | permissive (?:free software )?licen[cs]e
copyleft | 4 | copyleft | copyleft licen[cs]e
all-rights-reserved | 4 | reserved | all rights reserved
copyright-notice | 4 | copyright | copyright (?:c )?(?:19|20)\d\d
noncommercial | 4 | commercial | (?:non|not for) commercial (?:use|purposes)
"""


@dataclass(frozen=True)
class Rule:
    label: str
    level: int
    keyword: str
    pattern: str
    base: bool = False


def parse(lines, base: bool = False) -> list[Rule]:
    rules = []
    for line in lines:
        label, level, keyword, pattern = (part.strip() for part in line.split(" | ", 3))
        rules.append(Rule(label, int(level), keyword, pattern, base))
    return rules


def default_rules() -> list[Rule]:
    """The base phrases, then the rules above, in order of priority within a level."""
    return parse(BASE, base=True) + parse(RULES.strip().splitlines())
