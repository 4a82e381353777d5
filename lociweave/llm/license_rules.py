"""Signatures of licences over lower-cased words with single spaces between them.

One rule a line: label, priority, keyword, regular expression. The keyword is
a word of every match. Priorities: 1 identifier tags, 2 sentences of grants
and licence texts, 3 names with a version, 4 names, 5 hints. Repetitions are
bounded, so a match spans few words.
"""

RULES_TEXT = r"""
apache-2.0 1 spdx spdx license identifier apache 2 0
apache-2.0 2 apache (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?apache licen[sc]e (?:version |v ?)?2(?: 0)?
apache-2.0 2 apache you may not use this file except in compliance with the license(?: \S+){0,24} apache(?: \S+){0,3} licenses? 2 0
apache-2.0 3 apache (?:the )?apache (?:software )?licen[sc]e (?:version |v ?)?2(?: 0)?
apache-2.0 3 apache apache (?:v )?2 0(?: licen[sc]ed?)?
apache-2.0 3 asl asl (?:version |v ?)?2 0
apache-1.1 1 spdx spdx license identifier apache 1 1
apache-1.1 3 apache apache (?:software )?licen[sc]e (?:version |v ?)?1 1
apache-1.0 3 apache apache (?:software )?licen[sc]e (?:version |v ?)?1 0
apache 4 apache apache(?: software)? licen[sc]e
apache 4 apache (?:an? )?apache licensed
mit 1 spdx spdx license identifier mit
mit 1 osi license osi approved mit license
mit 2 deal permission is hereby granted free of charge to any person obtaining a copy(?: \S+){0,12} to deal in the software without restriction
mit 2 mit (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?mit licen[sc]e
mit 3 expat (?:the )?expat licen[sc]e
mit 4 mit (?:the )?mit licen[sc]e
mit 4 mit mit licen[sc]ed
mit-0 1 spdx spdx license identifier mit 0
mit-0 3 attribution mit no attribution(?: license)?
x11 1 spdx spdx license identifier x11
x11 4 x11 (?:the )?(?:mit )?x11 licen[sc]e
gpl-3.0 1 spdx spdx license identifier gpl 3 0(?: or later| only)?
gpl-3.0 2 gnu (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?gnu general public licen[sc]e(?: as published by the free software foundation)? (?:either )?(?:version |v ?)?3(?: 0)?
gpl-3.0 2 redistribute you can redistribute it and or modify it under the terms of the gnu general public license(?: \S+){0,10} version 3
gpl-3.0 3 general (?:gnu )?general public licen[sc]e (?:version |v ?)?3(?: 0)?
gpl-3.0 3 gpl (?:gnu )?gpl (?:version |v ?)?3(?: 0)?
gpl-3.0 3 gplv3 (?:gnu )?gplv3
gpl-2.0 1 spdx spdx license identifier gpl 2 0(?: or later| only)?
gpl-2.0 2 gnu (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?gnu general public licen[sc]e(?: as published by the free software foundation)? (?:either )?(?:version |v ?)?2(?: 0)?
gpl-2.0 2 redistribute you can redistribute it and or modify it under the terms of the gnu general public license(?: \S+){0,10} version 2
gpl-2.0 3 general (?:gnu )?general public licen[sc]e (?:version |v ?)?2(?: 0)?
gpl-2.0 3 gpl (?:gnu )?gpl (?:version |v ?)?2(?: 0)?
gpl-2.0 3 gplv2 (?:gnu )?gplv2
gpl-1.0 1 spdx spdx license identifier gpl 1 0(?: or later| only)?
gpl-1.0 3 general (?:gnu )?general public licen[sc]e (?:version |v ?)?1(?: 0)?
gpl 2 warranty this program is distributed in the hope that it will be useful but without any warranty
gpl 2 gnu you should have received a copy of the gnu general public license
gpl 4 general (?:gnu )?general public licen[sc]e
gpl 4 gpl (?:gnu )?gpl(?: licen[sc]ed?)?
gpl-classpath 3 classpath (?:gpl|general public license)(?: \S+){0,6} classpath exception
lgpl-3.0 1 spdx spdx license identifier lgpl 3 0(?: or later| only)?
lgpl-3.0 3 lesser (?:gnu )?lesser general public licen[sc]e (?:version |v ?)?3(?: 0)?
lgpl-3.0 3 lgpl lgpl (?:version |v ?)?3(?: 0)?
lgpl-3.0 3 lgplv3 lgplv3
lgpl-2.1 1 spdx spdx license identifier lgpl 2 1(?: or later| only)?
lgpl-2.1 3 lesser (?:gnu )?lesser general public licen[sc]e (?:version |v ?)?2 1
lgpl-2.1 3 lgpl lgpl (?:version |v ?)?2 1
lgpl-2.0 1 spdx spdx license identifier lgpl 2 0(?: or later| only)?
lgpl-2.0 3 library (?:gnu )?library general public licen[sc]e(?: (?:version |v ?)?2(?: 0)?)?
lgpl 2 lesser under the terms of the (?:gnu )?lesser general public licen[sc]e
lgpl 4 lesser (?:gnu )?lesser general public licen[sc]e
lgpl 4 lgpl (?:gnu )?lgpl(?: licen[sc]ed?)?
agpl-3.0 1 spdx spdx license identifier agpl 3 0(?: or later| only)?
agpl-3.0 3 affero (?:gnu )?affero general public licen[sc]e (?:version |v ?)?3(?: 0)?
agpl-3.0 3 agpl agpl (?:version |v ?)?3(?: 0)?
agpl-3.0 3 agplv3 agplv3
agpl-1.0 3 affero affero general public licen[sc]e (?:version |v ?)?1(?: 0)?
agpl 4 affero (?:gnu )?affero general public licen[sc]e
agpl 4 agpl (?:gnu )?agpl
gfdl-1.3 1 spdx spdx license identifier gfdl 1 3(?: or later| only)?
gfdl-1.3 3 documentation (?:gnu )?free documentation licen[sc]e (?:version |v ?)?1 3
gfdl-1.2 1 spdx spdx license identifier gfdl 1 2(?: or later| only)?
gfdl-1.2 3 documentation (?:gnu )?free documentation licen[sc]e (?:version |v ?)?1 2
gfdl 2 invariant with no invariant sections no front cover texts and no back cover texts
gfdl 4 documentation (?:gnu )?free documentation licen[sc]e
gfdl 4 gfdl (?:gnu )?gfdl
bsd-3-clause 1 spdx spdx license identifier bsd 3 clause
bsd-3-clause 2 endorse neither the name of(?: \S+){1,10} nor the names of its contributors may be used to endorse or promote products
bsd-3-clause 3 clause (?:bsd 3 clause|3 clause bsd)(?: licen[sc]e)?
bsd-3-clause 3 bsd (?:new|revised|modified) bsd licen[sc]e
bsd-3-clause 3 bsd three clause bsd(?: licen[sc]e)?
bsd-2-clause 1 spdx spdx license identifier bsd 2 clause
bsd-2-clause 3 clause (?:bsd 2 clause|2 clause bsd)(?: licen[sc]e)?
bsd-2-clause 3 bsd (?:simplified|freebsd) bsd licen[sc]e
bsd-2-clause 3 bsd two clause bsd(?: licen[sc]e)?
bsd-4-clause 1 spdx spdx license identifier bsd 4 clause
bsd-4-clause 2 advertising all advertising materials mentioning features or use of this software must display
bsd-4-clause 3 bsd (?:original|old|4 clause|four clause) bsd(?: licen[sc]e)?
bsd-0-clause 1 spdx spdx license identifier 0bsd
bsd-0-clause 3 bsd (?:zero|0) clause bsd(?: licen[sc]e)?
bsd-1-clause 1 spdx spdx license identifier bsd 1 clause
bsd 2 redistribution redistribution and use in source and binary forms with or without modification are permitted
bsd 4 bsd bsd(?: style)? licen[sc]ed?
isc 1 spdx spdx license identifier isc
isc 2 isc (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?isc licen[sc]e
isc 2 copy permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc 4 isc (?:the )?isc licen[sc]e
mpl-2.0 1 spdx spdx license identifier mpl 2 0
mpl-2.0 2 mozilla subject to the terms of the mozilla public license v(?:ersion)? 2 0
mpl-2.0 3 mozilla mozilla public licen[sc]e (?:version |v ?)?2(?: 0)?
mpl-2.0 3 mpl mpl (?:version |v ?)?2(?: 0)?
mpl-1.1 1 spdx spdx license identifier mpl 1 1
mpl-1.1 3 mozilla mozilla public licen[sc]e (?:version |v ?)?1 1
mpl-1.1 3 mpl mpl (?:version |v ?)?1 1
mpl-1.0 3 mozilla mozilla public licen[sc]e (?:version |v ?)?1 0
mpl 4 mozilla mozilla public licen[sc]e
mpl 4 mpl mpl licen[sc]ed?
epl-2.0 1 spdx spdx license identifier epl 2 0
epl-2.0 3 eclipse eclipse public licen[sc]e (?:version |v ?)?2(?: 0)?
epl-2.0 3 epl epl (?:version |v ?)?2(?: 0)?
epl-1.0 1 spdx spdx license identifier epl 1 0
epl-1.0 3 eclipse eclipse public licen[sc]e (?:version |v ?)?1(?: 0)?
epl-1.0 3 epl epl (?:version |v ?)?1(?: 0)?
epl 4 eclipse eclipse public licen[sc]e
edl-1.0 3 eclipse eclipse distribution licen[sc]e(?: (?:version |v ?)?1(?: 0)?)?
cddl-1.1 1 spdx spdx license identifier cddl 1 1
cddl-1.1 3 cddl cddl (?:version |v ?)?1 1
cddl-1.0 1 spdx spdx license identifier cddl 1 0
cddl-1.0 3 cddl cddl (?:version |v ?)?1 0
cddl 4 cddl cddl
cddl 4 distribution common development and distribution licen[sc]e
cpl-1.0 1 spdx spdx license identifier cpl 1 0
cpl-1.0 3 common common public licen[sc]e(?: (?:version |v ?)?1 0)?
eupl-1.2 1 spdx spdx license identifier eupl 1 2
eupl-1.2 3 eupl eupl (?:version |v ?)?1 2
eupl-1.1 1 spdx spdx license identifier eupl 1 1
eupl-1.1 3 eupl eupl (?:version |v ?)?1 1
eupl 4 european european union public licen[sc]e
eupl 4 eupl eupl
osl-3.0 1 spdx spdx license identifier osl 3 0
osl-3.0 3 open open software licen[sc]e (?:version |v ?)?3(?: 0)?
afl-3.0 1 spdx spdx license identifier afl 3 0
afl-3.0 3 academic academic free licen[sc]e(?: (?:version |v ?)?3(?: 0)?)?
artistic-2.0 1 spdx spdx license identifier artistic 2 0
artistic-2.0 3 artistic artistic licen[sc]e (?:version |v ?)?2(?: 0)?
artistic-1.0 1 spdx spdx license identifier artistic 1 0(?: perl)?
artistic-1.0 3 artistic artistic licen[sc]e (?:version |v ?)?1(?: 0)?
artistic 4 artistic (?:perl )?artistic licen[sc]e
perl 2 perl same terms as perl itself
bsl-1.0 1 spdx spdx license identifier bsl 1 0
bsl-1.0 2 boost distributed under the boost software license
bsl-1.0 3 boost boost software licen[sc]e(?: (?:version |v ?)?1(?: 0)?)?
busl-1.1 1 spdx spdx license identifier busl 1 1
busl-1.1 3 business business source licen[sc]e(?: (?:version |v ?)?1 1)?
sspl-1.0 1 spdx spdx license identifier sspl 1 0
sspl-1.0 3 server server side public licen[sc]e(?: (?:version |v ?)?1(?: 0)?)?
sspl-1.0 4 sspl sspl
elastic-2.0 1 spdx spdx license identifier elastic 2 0
elastic-2.0 3 elastic elastic licen[sc]e(?: (?:version |v ?)?2(?: 0)?)?
commons-clause 3 commons commons clause(?: licen[sc]e)?(?: condition)?
unlicense 1 spdx spdx license identifier unlicense
unlicense 2 unencumbered this is free and unencumbered software released into the public domain
unlicense 4 unlicense (?:the )?unlicense
cc0-1.0 1 spdx spdx license identifier cc0 1 0
cc0-1.0 2 cc0 to the extent possible under law(?: \S+){0,30} cc0(?: 1 0)?
cc0-1.0 3 cc0 cc0(?: 1 0)?(?: universal)?
cc0-1.0 3 commons creative commons zero(?: v?1 0)?(?: universal)?
cc-by-4.0 1 spdx spdx license identifier cc by 4 0
cc-by-4.0 2 commons licensed under (?:a |the )?creative commons attribution 4 0(?: international)?(?: licen[sc]e)?
cc-by-4.0 3 cc cc by 4 0
cc-by-4.0 3 attribution creative commons attribution 4 0
cc-by-3.0 1 spdx spdx license identifier cc by 3 0
cc-by-3.0 3 cc cc by 3 0
cc-by-3.0 3 attribution creative commons attribution 3 0
cc-by-2.0 3 cc cc by 2 [05]
cc-by-sa-4.0 1 spdx spdx license identifier cc by sa 4 0
cc-by-sa-4.0 3 sa cc by sa 4 0
cc-by-sa-4.0 3 sharealike creative commons attribution sharealike 4 0
cc-by-sa-3.0 1 spdx spdx license identifier cc by sa 3 0
cc-by-sa-3.0 3 sa cc by sa 3 0
cc-by-sa-3.0 3 sharealike creative commons attribution sharealike 3 0
cc-by-sa 4 sa cc by sa
cc-by-sa 4 alike creative commons attribution share alike
cc-by-sa 4 sharealike creative commons attribution sharealike
cc-by-nc-4.0 1 spdx spdx license identifier cc by nc 4 0
cc-by-nc-4.0 2 nc licensed under cc by nc 4 0
cc-by-nc-4.0 3 nc cc by nc 4 0
cc-by-nc-4.0 3 noncommercial creative commons attribution noncommercial 4 0
cc-by-nc-3.0 1 spdx spdx license identifier cc by nc 3 0
cc-by-nc-3.0 3 nc cc by nc 3 0
cc-by-nc 4 nc cc by nc
cc-by-nc 4 noncommercial creative commons attribution noncommercial
cc-by-nc 4 commercial creative commons attribution non commercial
cc-by-nc-sa-4.0 1 spdx spdx license identifier cc by nc sa 4 0
cc-by-nc-sa-4.0 3 sa cc by nc sa 4 0
cc-by-nc-sa-4.0 3 sharealike creative commons attribution noncommercial sharealike 4 0
cc-by-nc-sa-3.0 1 spdx spdx license identifier cc by nc sa 3 0
cc-by-nc-sa-3.0 3 sa cc by nc sa 3 0
cc-by-nc-sa 4 sa cc by nc sa
cc-by-nc-nd-4.0 1 spdx spdx license identifier cc by nc nd 4 0
cc-by-nc-nd-4.0 3 nd cc by nc nd 4 0
cc-by-nc-nd-4.0 3 noderivatives creative commons attribution noncommercial noderivatives 4 0
cc-by-nc-nd-3.0 3 nd cc by nc nd 3 0
cc-by-nc-nd 4 nd cc by nc nd
cc-by-nd-4.0 1 spdx spdx license identifier cc by nd 4 0
cc-by-nd-4.0 3 nd cc by nd 4 0
cc-by-nd 4 nd cc by nd
cc-by 4 commons creative commons attribution(?: licen[sc]e)?
cc-by 5 cc cc by
cc 5 commons creative commons(?: licen[sc]e)?
odbl-1.0 1 spdx spdx license identifier odbl 1 0
odbl-1.0 3 database open (?:data commons open )?database licen[sc]e
odbl-1.0 4 odbl odbl
odc-by-1.0 1 spdx spdx license identifier odc by 1 0
odc-by-1.0 3 commons open data commons attribution licen[sc]e
odc-by-1.0 3 odc odc by(?: 1 0)?
pddl-1.0 3 dedication public domain dedication and licen[sc]e
pddl-1.0 4 pddl pddl
ogl-uk-3.0 3 government open government licen[sc]e(?: (?:version |v ?)?3(?: 0)?)?
cdla-permissive-2.0 3 community community data licen[sc]e agreement permissive(?: (?:version |v ?)?2 0)?
cdla-sharing-1.0 3 community community data licen[sc]e agreement sharing(?: (?:version |v ?)?1 0)?
zlib 1 spdx spdx license identifier zlib
zlib 2 misrepresented altered source versions must be plainly marked as such and must not be misrepresented
zlib 4 zlib (?:the )?zlib(?: libpng)? licen[sc]e
libpng 1 spdx spdx license identifier libpng(?: 2 0)?
libpng 4 libpng libpng licen[sc]e
bzip2 1 spdx spdx license identifier bzip2 1 0 6
openssl 1 spdx spdx license identifier openssl
openssl 4 openssl openssl licen[sc]e
curl 1 spdx spdx license identifier curl
python-2.0 1 spdx spdx license identifier (?:python 2 0|psf 2 0)
python-2.0 3 python python software foundation licen[sc]e(?: version 2)?
python-2.0 4 psf psf licen[sc]e
postgresql 1 spdx spdx license identifier postgresql
postgresql 4 postgresql postgresql licen[sc]e
php-3.01 1 spdx spdx license identifier php 3 01
php-3.01 3 php php licen[sc]e (?:version |v ?)?3(?: 01| 0)?
php 4 php php licen[sc]e
ruby 1 spdx spdx license identifier ruby
ruby 2 ruby same terms as ruby
ruby 4 ruby ruby licen[sc]e
w3c 1 spdx spdx license identifier w3c
w3c 4 w3c w3c(?: software)?(?: notice and)? licen[sc]e
ofl-1.1 1 spdx spdx license identifier ofl 1 1
ofl-1.1 3 font (?:sil )?open font licen[sc]e(?: (?:version |v ?)?1 1)?
ofl-1.1 4 ofl (?:sil )?ofl(?: 1 1)?
wtfpl 1 spdx spdx license identifier wtfpl
wtfpl 4 wtfpl wtfpl
beerware 3 beer the beer ware licen[sc]e
beerware 4 beerware beerware
ncsa 1 spdx spdx license identifier ncsa
ncsa 3 illinois university of illinois(?: ncsa)? open source licen[sc]e
upl-1.0 1 spdx spdx license identifier upl 1 0
upl-1.0 3 permissive universal permissive licen[sc]e
ms-pl 1 spdx spdx license identifier ms pl
ms-pl 3 microsoft microsoft public licen[sc]e
ms-rl 1 spdx spdx license identifier ms rl
ms-rl 3 microsoft microsoft reciprocal licen[sc]e
cecill-2.1 1 spdx spdx license identifier cecill 2 1
cecill 4 cecill cecill(?: licen[sc]e)?
blueoak-1.0.0 1 spdx spdx license identifier blueoak 1 0 0
blueoak-1.0.0 3 oak blue oak model licen[sc]e
mulanpsl-2.0 1 spdx spdx license identifier mulanpsl 2 0
mulanpsl-2.0 3 mulan mulan permissive software licen[sc]e
vim 1 spdx spdx license identifier vim
openrail 3 rail (?:creativeml )?open rail(?: m| \+\+ m)?(?: licen[sc]e)?
openrail 3 openrail (?:creativeml )?openrail(?: m)?
llama-community 3 llama llama [234]?(?: [0-9])? ?community licen[sc]e
gemma 3 gemma gemma terms of use
public-domain 2 domain (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain 5 domain public domain
proprietary 2 confidential proprietary and confidential
proprietary 2 unauthorized unauthorized (?:copying|use|reproduction|distribution)(?: \S+){0,8} (?:is )?(?:strictly )?prohibited
proprietary 5 reserved all rights reserved
non-commercial 2 commercial for non ?commercial (?:use|purposes|research)(?: only)?
non-commercial 2 noncommercial for noncommercial (?:use|purposes|research)(?: only)?
non-commercial 5 nc by nc
no-derivatives 2 derivatives no derivatives
share-alike 5 sharealike sharealike
dual 3 dual dual licen[sc]ed
licensed 5 licensed (?:is )?licensed under (?:the )?(?:terms of )?(?:the )?\S+(?: \S+)? licen[sc]e
license-file 5 license see (?:the )?license(?: file)? for(?: more)? details
copyright 5 copyright copyright (?:c )?(?:19|20)[0-9]{2}
"""
