"""Signatures of licences, written by hand: what notices, clauses, names, tags and addresses look like."""

from __future__ import annotations

#: Fixed values. A line is a rule: label | rank | keywords | expression. Expressions run over lower-case words with one space
#: between them (punctuation is gone: GPL-2.0 is "gpl 2 0") and match whole words. Every place of a rule has one of its
#: keywords; / stands between keywords. Ranks: 5 a licence's own text or a machine-readable tag, 4 a grant that names the
#: licence, 3 its name with a version, or its address, 2 its name, 1 a hint.
SIGNATURES = r"""
mit | 5 | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 5 | without restriction including | to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense
mit | 4 | the above copyright notice and this permission notice | the above copyright notice and this permission notice shall be included in all copies or substantial portions
mit | 4 | shall the authors or copyright holders | in no event shall the authors or copyright holders be liable for any claim damages or other liability
mit | 5 | spdx license identifier mit | spdx license identifier mit
mit | 4 | mit licen | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?mit licen[cs]e
mit | 4 | mit licen | (?:subject to|governed by|covered by) (?:the )?(?:terms of )?(?:the )?mit licen[cs]e
mit | 3 | opensource org licenses mit | opensource org licenses mit(?: license(?: php)?)?
mit | 3 | under the mit | under the mit(?: open source)? licen[cs]e
mit | 2 | mit licen | (?:the )?mit licen[cs]e(?: mit)?
mit | 2 | expat licen | (?:the )?expat licen[cs]e
mit | 2 | mit x11 / x11 mit | (?:mit x11|x11 mit) licen[cs]e
mit | 2 | license mit / licence mit | licen[cs]e mit
mit | 1 | mit style / mit like | mit (?:style|like) licen[cs]e
mit-0 | 5 | spdx license identifier mit 0 | spdx license identifier mit 0
mit-0 | 3 | mit no attribution | mit no attribution(?: licen[cs]e)?
x11 | 5 | spdx license identifier x11 | spdx license identifier x11
x11 | 4 | x consortium | except as contained in this notice the name of the x consortium shall not be used
x11 | 2 | x11 licen | (?:the )?x11 licen[cs]e
isc | 5 | permission to use copy modify | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
isc | 4 | the author disclaims all warranties | the author disclaims all warranties with regard to this software
isc | 5 | spdx license identifier isc | spdx license identifier isc
isc | 4 | isc licen | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?isc licen[cs]e
isc | 3 | opensource org licenses isc | opensource org licenses isc(?: license)?
isc | 2 | isc licen | (?:the )?isc licen[cs]e
0bsd | 5 | spdx license identifier 0bsd | spdx license identifier 0bsd
0bsd | 3 | zero clause bsd / bsd zero clause / 0bsd | (?:zero clause bsd|bsd zero clause|0bsd)(?: licen[cs]e)?
bsd | 5 | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification are permitted provided that
bsd | 4 | redistributions of source code must retain | redistributions of source code must retain the above copyright notice this list of conditions
bsd | 4 | redistributions in binary form must reproduce | redistributions in binary form must reproduce the above copyright notice this list of conditions
bsd-3-clause | 5 | neither the name of | neither the name of .{1,80}? nor the names of (?:its|their|any) contributors may be used to endorse
bsd-3-clause | 4 | may be used to endorse or promote | contributors may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause | 5 | all advertising materials mentioning | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd | 4 | regents and contributors | this software is provided by the regents and contributors as is
bsd | 4 | copyright holders and contributors | this software is provided by the copyright holders and contributors as is
bsd-2-clause | 5 | spdx license identifier bsd 2 clause | spdx license identifier bsd 2 clause(?: patent| views)?
bsd-3-clause | 5 | spdx license identifier bsd 3 clause | spdx license identifier bsd 3 clause(?: clear| lbnl)?
bsd-4-clause | 5 | spdx license identifier bsd 4 clause | spdx license identifier bsd 4 clause(?: uc)?
bsd | 4 | bsd licen / bsd style licen | (?:licensed|released|distributed|available|provided|published) under (?:the |a )?(?:terms of )?(?:the |a )?bsd(?: style)? licen[cs]e
bsd-2-clause | 4 | simplified bsd / bsd 2 clause / 2 clause bsd / two clause bsd / freebsd | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd|freebsd) licen[cs]e
bsd-3-clause | 4 | new bsd / modified bsd / revised bsd / bsd 3 clause / 3 clause bsd / three clause bsd | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd) licen[cs]e
bsd-2-clause | 3 | opensource org licenses bsd 2 clause | opensource org licenses bsd 2 clause
bsd-3-clause | 3 | opensource org licenses bsd 3 clause | opensource org licenses bsd 3 clause
bsd | 3 | opensource org licenses bsd license | opensource org licenses bsd license(?: php)?
bsd-2-clause | 3 | bsd 2 clause / 2 clause bsd / two clause bsd | (?:bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[cs]e)?
bsd-3-clause | 3 | bsd 3 clause / 3 clause bsd / three clause bsd | (?:bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[cs]e)?
bsd-4-clause | 3 | bsd 4 clause / 4 clause bsd / four clause bsd | (?:bsd 4 clause|4 clause bsd|four clause bsd)(?: licen[cs]e)?
bsd-2-clause | 2 | simplified bsd licen / freebsd licen | (?:simplified bsd|freebsd) licen[cs]e
bsd-3-clause | 2 | new bsd licen / modified bsd licen / revised bsd licen | (?:new|modified|revised) bsd licen[cs]e
bsd-4-clause | 2 | original bsd licen | original bsd licen[cs]e
bsd | 2 | bsd licen | (?:the )?bsd licen[cs]e
bsd | 2 | license bsd / licence bsd | licen[cs]e bsd
bsd | 1 | bsd style / bsd like | bsd (?:style|like) licen[cs]e
apache-2 | 5 | you may not use this file except in compliance | you may not use this file except in compliance with the licen[cs]e
apache-2 | 5 | licensed under the apache licen | licensed under the apache licen[cs]e version 2(?: 0)?(?: the license)?
apache-2 | 5 | spdx license identifier apache 2 | spdx license identifier apache 2(?: 0)?
apache-2 | 4 | licensed to the apache software foundation | licensed to the apache software foundation(?: asf)? under one or more contributor licen[cs]e agreements
apache-2 | 4 | apache | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?apache(?: software)?(?: licen[cs]e)?(?: v| version)? ?2(?: 0)?(?: licen[cs]e)?
apache-2 | 4 | unless required by applicable law | unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis
apache-2 | 4 | terms and conditions for use reproduction | apache licen[cs]e version 2 0 january 2004 (?:.{0,60} )?terms and conditions for use reproduction and distribution
apache-2 | 3 | apache org licenses license 2 0 | apache org licenses license 2 0(?: txt| html)?
apache-2 | 3 | opensource org licenses apache 2 0 | opensource org licenses apache 2 0
apache-2 | 3 | apache | apache(?: software)?(?: public)? licen[cs]e(?: v| version)? ?2(?: 0)?
apache-2 | 3 | apache 2 | apache 2(?: 0)?(?: licen[cs]e)?
apache-2 | 3 | asl 2 0 | asl 2 0
apache-1.1 | 5 | spdx license identifier apache 1 1 | spdx license identifier apache 1 1
apache-1.1 | 3 | apache | apache(?: software)? licen[cs]e(?: v| version)? ?1 1
apache-1.0 | 5 | spdx license identifier apache 1 0 | spdx license identifier apache 1 0
apache-1.0 | 3 | apache | apache(?: software)? licen[cs]e(?: v| version)? ?1 0
apache | 4 | apache | (?:licensed|released|distributed|available|provided|published) under (?:the |an )?(?:terms of )?(?:the )?apache(?: software)? licen[cs]e
apache | 2 | apache licen / apache software licen | apache(?: software)? licen[cs]e
apache | 2 | license apache / licence apache | licen[cs]e apache
apache | 1 | apache style | apache style licen[cs]e
gpl | 5 | this program is free software | this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
gpl | 4 | free software you can redistribute it | is free software you can redistribute it and or modify it under the terms
gpl | 4 | you should have received a copy of the gnu general public | you should have received a copy of the gnu general public licen[cs]e
gpl | 4 | without even the implied warranty | without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public licen[cs]e
gpl-2.0 | 5 | either version 2 of the licen | either version 2 of the licen[cs]e or at your option any later version
gpl-3.0 | 5 | either version 3 of the licen | either version 3 of the licen[cs]e or at your option any later version
gpl-2.0 | 5 | spdx license identifier gpl 2 0 | spdx license identifier gpl 2 0(?: only| or later)?
gpl-3.0 | 5 | spdx license identifier gpl 3 0 | spdx license identifier gpl 3 0(?: only| or later)?
gpl-1.0 | 5 | spdx license identifier gpl 1 0 | spdx license identifier gpl 1 0(?: only| or later)?
gpl-2.0 | 4 | gpl / general public | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:gpl|general public licen[cs]e)(?: v| version)? ?2(?: 0)?
gpl-3.0 | 4 | gpl / general public | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:gpl|general public licen[cs]e)(?: v| version)? ?3(?: 0)?
gpl | 4 | gpl / general public | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:gpl|general public licen[cs]e)
gpl-2.0 | 4 | general public | gnu general public licen[cs]e version 2(?: 0)?(?: june 1991)?
gpl-3.0 | 4 | general public | gnu general public licen[cs]e version 3(?: 0)?(?: 29 june 2007)?
gpl-2.0 | 3 | gnu org licenses | gnu org licenses(?: old licenses)? gpl 2 0(?: html| txt)?
gpl-3.0 | 3 | gnu org licenses | gnu org licenses gpl 3 0(?: html| txt)?
gpl | 3 | gnu org licenses gpl | gnu org licenses gpl(?: html| txt)?
gpl-2.0 | 3 | gpl | (?:gnu )?gpl(?: v| version)? ?2(?: 0)?(?: only| or later)?
gpl-3.0 | 3 | gpl | (?:gnu )?gpl(?: v| version)? ?3(?: 0)?(?: only| or later)?
gpl-2.0 | 3 | gplv2 | (?:gnu )?gplv2
gpl-3.0 | 3 | gplv3 | (?:gnu )?gplv3
gpl | 2 | general public licen | (?:gnu )?general public licen[cs]e
gpl | 2 | gnu gpl | gnu gpl
gpl | 2 | license gpl / licence gpl / gpl licen | (?:licen[cs]e gpl|gpl licen[cs]e)
gpl | 1 | copyleft | copyleft
gpl-exception | 4 | gcc runtime library exception | gcc runtime library exception
gpl-exception | 4 | classpath exception | (?:gnu )?classpath exception
gpl-exception | 3 | as a special exception | as a special exception (?:the copyright holders?|if you link|you may)
lgpl | 5 | this library is free software | this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e
lgpl | 4 | you should have received a copy of the gnu l | you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e
lgpl-2.1 | 5 | either version 2 1 of the licen | either version 2 1 of the licen[cs]e or at your option any later version
lgpl-2.1 | 5 | spdx license identifier lgpl 2 1 | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-2.0 | 5 | spdx license identifier lgpl 2 0 | spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-3.0 | 5 | spdx license identifier lgpl 3 0 | spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-2.1 | 4 | lgpl / lesser general public / library general public | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:lgpl|lesser general public licen[cs]e)(?: v| version)? ?2 1
lgpl-3.0 | 4 | lgpl / lesser general public / library general public | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:lgpl|lesser general public licen[cs]e)(?: v| version)? ?3(?: 0)?
lgpl | 4 | lgpl / lesser general public / library general public | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:lgpl|(?:lesser|library) general public licen[cs]e)
lgpl-2.1 | 3 | general public | (?:gnu )?lesser general public licen[cs]e(?: v| version)? ?2 1
lgpl-3.0 | 3 | general public | (?:gnu )?lesser general public licen[cs]e(?: v| version)? ?3(?: 0)?
lgpl-2.0 | 3 | library general public | (?:gnu )?library general public licen[cs]e(?: v| version)? ?2(?: 0)?
lgpl-2.1 | 3 | lgpl / lgplv2 1 | (?:gnu )?(?:lgplv2 1|lgpl(?: v| version)? ?2 1)
lgpl-3.0 | 3 | lgpl | (?:gnu )?(?:lgplv3|lgpl(?: v| version)? ?3(?: 0)?)
lgpl | 3 | gnu org licenses lgpl | gnu org licenses lgpl(?: html| txt)?
lgpl | 2 | lesser general public / library general public | (?:gnu )?(?:lesser|library) general public licen[cs]e
lgpl | 2 | gnu lgpl / lgpl licen / license lgpl | (?:gnu lgpl|lgpl licen[cs]e|license lgpl)
agpl | 5 | gnu affero general public | under the terms of the gnu affero general public licen[cs]e
agpl | 4 | you should have received a copy of the gnu affero | you should have received a copy of the gnu affero general public licen[cs]e
agpl-3.0 | 5 | spdx license identifier agpl 3 0 | spdx license identifier agpl 3 0(?: only| or later)?
agpl-1.0 | 5 | spdx license identifier agpl 1 0 | spdx license identifier agpl 1 0(?: only| or later)?
agpl-3.0 | 4 | agpl / affero general public | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:agpl|affero general public licen[cs]e)(?: v| version)? ?3(?: 0)?
agpl | 4 | agpl / affero general public | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:agpl|affero general public licen[cs]e)
agpl-3.0 | 3 | affero general public | (?:gnu )?affero general public licen[cs]e(?: v| version)? ?3(?: 0)?
agpl-3.0 | 3 | agpl | (?:gnu )?(?:agplv3|agpl(?: v| version)? ?3(?: 0)?)
agpl | 3 | gnu org licenses agpl | gnu org licenses agpl(?: 3 0)?(?: html| txt)?
agpl | 2 | affero general public | (?:gnu )?affero general public licen[cs]e
agpl | 2 | agpl licen / license agpl / gnu agpl | (?:gnu agpl|agpl licen[cs]e|license agpl)
gfdl | 5 | permission is granted to copy distribute and or modify this document | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e
gfdl-1.3 | 5 | spdx license identifier gfdl 1 3 | spdx license identifier gfdl 1 3(?: only| or later)?
gfdl-1.2 | 5 | spdx license identifier gfdl 1 2 | spdx license identifier gfdl 1 2(?: only| or later)?
gfdl-1.3 | 3 | free documentation licen | (?:gnu )?free documentation licen[cs]e(?: v| version)? ?1 3
gfdl-1.2 | 3 | free documentation licen | (?:gnu )?free documentation licen[cs]e(?: v| version)? ?1 2
gfdl | 2 | free documentation licen | (?:gnu )?free documentation licen[cs]e
gfdl | 2 | gnu fdl / gfdl | (?:gnu fdl|gfdl)
mpl-2.0 | 5 | subject to the terms of the mozilla public | this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
mpl-2.0 | 4 | if a copy of the mpl was not distributed | if a copy of the mpl was not distributed with this file
mpl-1.1 | 5 | the contents of this file are subject to the mozilla public | the contents of this file are subject to the mozilla public licen[cs]e version 1 1
mpl-2.0 | 5 | spdx license identifier mpl 2 0 | spdx license identifier mpl 2 0(?: no copyleft exception)?
mpl-1.1 | 5 | spdx license identifier mpl 1 1 | spdx license identifier mpl 1 1
mpl-2.0 | 4 | mozilla public licen / mpl | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:mozilla public licen[cs]e|mpl)(?: v| version)? ?2(?: 0)?
mpl | 4 | mozilla public licen / mpl | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:mozilla public licen[cs]e|mpl)
mpl-2.0 | 3 | mozilla public licen | mozilla public licen[cs]e(?: v| version)? ?2(?: 0)?
mpl-1.1 | 3 | mozilla public licen | mozilla public licen[cs]e(?: v| version)? ?1 1
mpl-2.0 | 3 | mozilla org mpl 2 0 / mozilla org en us mpl 2 0 | mozilla org (?:en us )?mpl 2 0
mpl-2.0 | 3 | mpl 2 0 | mpl 2 0
mpl-1.1 | 3 | mpl 1 1 | mpl 1 1
mpl | 2 | mozilla public licen | mozilla public licen[cs]e
npl-1.1 | 3 | netscape public licen | netscape public licen[cs]e(?: v| version)?(?: 1 [01])?
epl-1.0 | 5 | eclipse public licen | made available under the terms of the eclipse public licen[cs]e v ?1(?: 0)?
epl-2.0 | 5 | eclipse public licen | made available under the terms of the eclipse public licen[cs]e (?:v ?)?2(?: 0)?
epl-1.0 | 5 | spdx license identifier epl 1 0 | spdx license identifier epl 1 0
epl-2.0 | 5 | spdx license identifier epl 2 0 | spdx license identifier epl 2 0
epl-1.0 | 3 | eclipse public licen | eclipse public licen[cs]e(?: v| version)? ?1(?: 0)?
epl-2.0 | 3 | eclipse public licen | eclipse public licen[cs]e(?: v| version)? ?2(?: 0)?
epl-1.0 | 3 | eclipse org legal epl v10 | eclipse org legal epl v10(?: html)?
epl-2.0 | 3 | eclipse org legal epl 2 0 / eclipse org legal epl v20 | eclipse org legal epl (?:2 0|v20)(?: html)?
epl | 2 | eclipse public licen | eclipse public licen[cs]e
edl-1.0 | 3 | eclipse distribution licen | eclipse distribution licen[cs]e(?: v| version)?(?: ?1 0)?
cpl-1.0 | 3 | common public licen | common public licen[cs]e(?: v| version)?(?: ?1 0)?
ipl-1.0 | 3 | ibm public licen | ibm public licen[cs]e(?: v| version)?(?: ?1 0)?
cddl-1.0 | 5 | common development and distribution licen | subject to the terms of the common development and distribution licen[cs]e
cddl-1.0 | 5 | spdx license identifier cddl 1 0 | spdx license identifier cddl 1 0
cddl-1.1 | 5 | spdx license identifier cddl 1 1 | spdx license identifier cddl 1 1
cddl-1.1 | 3 | common development and distribution licen | common development and distribution licen[cs]e(?: cddl)?(?: v| version)? ?1 1
cddl-1.0 | 2 | common development and distribution licen | common development and distribution licen[cs]e(?: cddl)?(?: v| version)?(?: ?1 0)?
cddl-1.0 | 2 | cddl | cddl(?: licen[cs]e)?(?: 1 0)?
artistic-2.0 | 5 | spdx license identifier artistic 2 0 | spdx license identifier artistic 2 0
artistic-1.0 | 5 | spdx license identifier artistic 1 0 | spdx license identifier artistic 1 0(?: perl| cl8)?
artistic-1.0 | 4 | under the same terms as perl | under the same terms as perl(?: itself| 5)?
artistic-2.0 | 3 | artistic licen | artistic licen[cs]e(?: v| version)? ?2(?: 0)?
artistic-1.0 | 3 | artistic licen | artistic licen[cs]e(?: v| version)? ?1(?: 0)?
artistic-1.0 | 2 | artistic licen | (?:the )?artistic licen[cs]e
zlib | 5 | this software is provided as is without any express or implied warranty | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | 4 | the origin of this software must not be misrepresented | the origin of this software must not be misrepresented
zlib | 4 | altered source versions must be plainly marked | altered source versions must be plainly marked as such
zlib | 5 | spdx license identifier zlib | spdx license identifier zlib
zlib | 3 | zlib licen / zlib libpng / zlib net zlib license | (?:zlib(?: libpng)? licen[cs]e|zlib libpng|zlib net zlib license(?: html)?)
libpng | 3 | libpng licen / libpng 2 0 | libpng (?:licen[cs]e|2 0)
boost-1.0 | 5 | boost software licen | distributed under the boost software licen[cs]e version 1 0
boost-1.0 | 5 | spdx license identifier bsl 1 0 | spdx license identifier bsl 1 0
boost-1.0 | 4 | to use reproduce display distribute execute | to use reproduce display distribute execute and transmit the software
boost-1.0 | 3 | boost org license 1 0 | boost org license 1 0(?: txt)?
boost-1.0 | 2 | boost software licen | boost software licen[cs]e(?: v| version)?(?: ?1 0)?
unlicense | 5 | this is free and unencumbered software | this is free and unencumbered software released into the public domain
unlicense | 4 | anyone is free to copy modify publish | anyone is free to copy modify publish use compile sell or distribute this software
unlicense | 5 | spdx license identifier unlicense | spdx license identifier unlicense
unlicense | 3 | unlicense org | unlicense org
unlicense | 2 | the unlicense / the unlicence | the unlicen[cs]e
public-domain | 4 | public domain | (?:released|dedicated|placed|donated) (?:in|into|to) the public domain
public-domain | 4 | public domain | (?:hereby|has been|have been) (?:released|dedicated|placed) (?:in|into|to) the public domain
public-domain | 3 | public domain | (?:is|are) in the public domain
public-domain | 3 | public domain | (?:no copyright|not subject to copyright|without copyright) (?:.{0,40} )?public domain
public-domain | 2 | public domain mark | public domain mark(?: 1 0)?
cc0-1.0 | 5 | spdx license identifier cc0 1 0 | spdx license identifier cc0 1 0
cc0-1.0 | 5 | waived all copyright | (?:has|have) waived all copyright and related or neighboring rights
cc0-1.0 | 4 | cc0 / creative commons zero | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:cc0|creative commons zero)(?: 1 0)?
cc0-1.0 | 3 | creativecommons org publicdomain zero | creativecommons org publicdomain zero 1 0
cc0-1.0 | 3 | cc0 1 0 / creative commons zero | (?:cc0 1 0(?: universal)?|creative commons zero(?: v1 0)?)
cc0-1.0 | 2 | cc0 | cc0(?: licen[cs]e)?
cc-by | 5 | spdx license identifier cc by | spdx license identifier cc by [1-4] [05]
cc-by-sa | 5 | spdx license identifier cc by sa | spdx license identifier cc by sa [1-4] [05]
cc-by-nd | 5 | spdx license identifier cc by nd | spdx license identifier cc by nd [1-4] [05]
cc-by-nc | 5 | spdx license identifier cc by nc | spdx license identifier cc by nc [1-4] [05]
cc-by-nc-sa | 5 | spdx license identifier cc by nc sa | spdx license identifier cc by nc sa [1-4] [05]
cc-by-nc-nd | 5 | spdx license identifier cc by nc nd | spdx license identifier cc by nc nd [1-4] [05]
cc-by | 4 | creative commons attribution | (?:licensed|released|distributed|available|provided|published) under (?:the |a )?(?:terms of )?(?:the |a )?creative commons attribution(?: [1-4] [05])?(?: international| generic| unported)?(?: licen[cs]e)?
cc-by-sa | 4 | creative commons attribution | (?:licensed|released|distributed|available|provided|published) under (?:the |a )?(?:terms of )?(?:the |a )?creative commons attribution share ?alike(?: [1-4] [05])?(?: international| generic| unported)?(?: licen[cs]e)?
cc-by-nd | 4 | creative commons attribution | (?:licensed|released|distributed|available|provided|published) under (?:the |a )?(?:terms of )?(?:the |a )?creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nc | 4 | creative commons attribution | (?:licensed|released|distributed|available|provided|published) under (?:the |a )?(?:terms of )?(?:the |a )?creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| generic| unported)?(?: licen[cs]e)?
cc-by-nc-sa | 4 | creative commons attribution | (?:licensed|released|distributed|available|provided|published) under (?:the |a )?(?:terms of )?(?:the |a )?creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nc-nd | 4 | creative commons attribution | (?:licensed|released|distributed|available|provided|published) under (?:the |a )?(?:terms of )?(?:the |a )?creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?(?: licen[cs]e)?
cc-by | 4 | cc by | (?:licensed|released|distributed|available|provided|published) under (?:the |a )?(?:terms of )?(?:the )?cc by(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-sa | 4 | cc by sa | (?:licensed|released|distributed|available|provided|published) under (?:the |a )?(?:terms of )?(?:the )?cc by sa(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nc | 4 | cc by nc | (?:licensed|released|distributed|available|provided|published) under (?:the |a )?(?:terms of )?(?:the )?cc by nc(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nc-sa | 4 | cc by nc sa | (?:licensed|released|distributed|available|provided|published) under (?:the |a )?(?:terms of )?(?:the )?cc by nc sa(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nc-nd | 4 | cc by nc nd | (?:licensed|released|distributed|available|provided|published) under (?:the |a )?(?:terms of )?(?:the )?cc by nc nd(?: [1-4] [05])?(?: licen[cs]e)?
cc-by | 3 | creativecommons org licenses by | creativecommons org licenses by(?: [1-4] [05])
cc-by-sa | 3 | creativecommons org licenses by sa | creativecommons org licenses by sa(?: [1-4] [05])?
cc-by-nd | 3 | creativecommons org licenses by nd | creativecommons org licenses by nd(?: [1-4] [05])?
cc-by-nc | 3 | creativecommons org licenses by nc | creativecommons org licenses by nc(?: [1-4] [05])?
cc-by-nc-sa | 3 | creativecommons org licenses by nc sa | creativecommons org licenses by nc sa(?: [1-4] [05])?
cc-by-nc-nd | 3 | creativecommons org licenses by nc nd | creativecommons org licenses by nc nd(?: [1-4] [05])?
cc-by | 3 | cc by | cc by [1-4] [05]
cc-by-sa | 3 | cc by sa | cc by sa(?: [1-4] [05])?
cc-by-nd | 3 | cc by nd | cc by nd(?: [1-4] [05])?
cc-by-nc | 3 | cc by nc | cc by nc(?: [1-4] [05])?
cc-by-nc-sa | 3 | cc by nc sa | cc by nc sa(?: [1-4] [05])?
cc-by-nc-nd | 3 | cc by nc nd | cc by nc nd(?: [1-4] [05])?
cc-by | 2 | creative commons attribution | creative commons attribution(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-sa | 2 | creative commons attribution | creative commons attribution share ?alike(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nd | 2 | creative commons attribution | creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nc | 2 | creative commons attribution | creative commons attribution non ?commercial(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nc-sa | 2 | creative commons attribution | creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nc-nd | 2 | creative commons attribution | creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?(?: licen[cs]e)?
cc | 1 | creative commons licen | creative commons licen[cs]e
cc | 1 | some rights reserved | some rights reserved
odbl-1.0 | 5 | spdx license identifier odbl 1 0 | spdx license identifier odbl 1 0
odbl-1.0 | 4 | open database licen | made available under the open database licen[cs]e
odbl-1.0 | 3 | opendatacommons org licenses odbl | opendatacommons org licenses odbl(?: 1 0)?
odbl-1.0 | 2 | open database licen / odbl | (?:open database licen[cs]e|odbl)(?: v?1 0)?
odc-by-1.0 | 3 | open data commons attribution / odc by | (?:open data commons attribution licen[cs]e|odc by)(?: v?1 0)?
pddl-1.0 | 3 | public domain dedication and licen | (?:open data commons )?public domain dedication and licen[cs]e
cdla | 3 | community data licen | community data licen[cs]e agreement(?: permissive| sharing)?(?: [12] 0)?
ogl-uk | 3 | open government licen | open government licen[cs]e(?: v| version)?(?: ?[1-3] 0)?
etalab-2.0 | 3 | licence ouverte / open licence | (?:licence ouverte|open licence)(?: etalab)?(?: v?2 0)?
dl-de | 3 | datenlizenz deutschland | datenlizenz deutschland(?: namensnennung| zero)?(?: 2 0)?
ofl-1.1 | 5 | this font software is licensed under the sil open font | this font software is licensed under the sil open font licen[cs]e version 1 1
ofl-1.1 | 5 | spdx license identifier ofl 1 1 | spdx license identifier ofl 1 1(?: rfn| no rfn)?
ofl-1.1 | 3 | scripts sil org ofl | scripts sil org ofl
ofl-1.1 | 2 | open font licen | (?:sil )?open font licen[cs]e(?: v| version)?(?: ?1 1)?
ubuntu-font-1.0 | 3 | ubuntu font licen | ubuntu font licen[cs]e(?: version)?(?: 1 0)?
gust-font | 3 | gust font licen | gust font licen[cs]e
psf-2.0 | 5 | this license agreement is between the python software foundation | this license agreement is between the python software foundation psf and the individual or organization
psf-2.0 | 5 | spdx license identifier p | spdx license identifier (?:psf 2 0|python 2 0)
psf-2.0 | 3 | python software foundation licen | python software foundation licen[cs]e(?: version)?(?: 2)?
psf-2.0 | 2 | psf licen / psfl | (?:psf licen[cs]e|psfl)
cnri-python | 3 | cnri | cnri (?:open source )?(?:python )?licen[cs]e(?: agreement)?
php-3.01 | 4 | php licen | subject to version 3 0?1 of the php licen[cs]e
php-3.01 | 2 | php licen | (?:the )?php licen[cs]e(?: v| version)?(?: 3 0?1)?
zend-2.0 | 2 | zend licen / zend engine licen | zend (?:engine )?licen[cs]e
ruby | 3 | ruby licen / ruby s licen | ruby (?:s )?licen[cs]e
ruby | 4 | under the same terms as ruby | under the same terms as ruby(?: itself)?
postgresql | 5 | spdx license identifier postgresql | spdx license identifier postgresql
postgresql | 4 | in no event shall the university of california | in no event shall the university of california be liable to any party
postgresql | 2 | postgresql licen / postgres licen | postgre(?:s|sql) licen[cs]e
ms-pl | 5 | spdx license identifier ms pl | spdx license identifier ms pl
ms-pl | 3 | microsoft public licen | microsoft public licen[cs]e(?: ms pl)?
ms-rl | 3 | microsoft reciprocal licen | microsoft reciprocal licen[cs]e(?: ms rl)?
ms-pl | 2 | ms pl licen | ms pl licen[cs]e
eupl-1.2 | 5 | licensed under the eupl | licensed under the eupl(?: version 1 2| v 1 2)?
eupl-1.2 | 5 | spdx license identifier eupl 1 2 | spdx license identifier eupl 1 2
eupl-1.1 | 5 | spdx license identifier eupl 1 1 | spdx license identifier eupl 1 1
eupl-1.2 | 2 | european union public licen / eupl | (?:european union public licen[cs]e|eupl)(?: v)?(?: ?1 2)?
cecill-2.1 | 5 | cecill | governed by the cecill(?: b| c)? licen[cs]e under french law
cecill-2.1 | 2 | cecill | cecill(?: licen[cs]e)?(?: v?2 [01])?
openssl | 5 | openssl project for use in the openssl toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
openssl | 4 | this product includes cryptographic software | this product includes cryptographic software written by eric young
openssl | 2 | openssl licen / ssleay licen | (?:openssl|ssleay) licen[cs]e
wtfpl | 5 | spdx license identifier wtfpl | spdx license identifier wtfpl
wtfpl | 4 | you want to public licen | do what the (?:fuck|hell) you want to public licen[cs]e
wtfpl | 2 | wtfpl | wtfpl(?: v?2)?
beerware | 4 | you can buy me a beer | if we meet some day and you think this stuff is worth it you can buy me a beer in return
beerware | 2 | beerware / beer ware | (?:beerware|beer ware)(?: licen[cs]e)?
json | 4 | shall be used for good not evil | the software shall be used for good not evil
curl | 5 | spdx license identifier curl | spdx license identifier curl
curl | 3 | curl licen / curl se docs copyright | curl (?:licen[cs]e|se docs copyright(?: html)?)
unicode | 5 | spdx license identifier unicode | spdx license identifier unicode (?:3 0|dfs 2015|dfs 2016)
unicode | 4 | data files or software without | to deal in the (?:unicode )?data files or software without restriction
unicode | 3 | unicode licen / unicode inc licen | unicode (?:inc )?licen[cs]e(?: agreement)?(?: v3)?
icu | 3 | icu licen | icu licen[cs]e
w3c | 5 | spdx license identifier w3c | spdx license identifier w3c(?: 20150513| 19980720)?
w3c | 3 | w3c software | w3c software (?:and document )?(?:notice and )?licen[cs]e
ncsa | 5 | spdx license identifier ncsa | spdx license identifier ncsa
ncsa | 3 | university of illinois | university of illinois(?: ncsa)?(?: open source)? licen[cs]e
afl-3.0 | 3 | academic free licen | academic free licen[cs]e(?: v| version)?(?: ?[123] [01])?
osl-3.0 | 3 | open software licen | open software licen[cs]e(?: v| version)?(?: [123] [01])?
ecl-2.0 | 3 | educational community licen | educational community licen[cs]e(?: v| version)?(?: ?2 0)?
qpl-1.0 | 3 | q public licen | (?:the )?q public licen[cs]e(?: version)?(?: 1 0)?
sleepycat | 3 | sleepycat licen | sleepycat licen[cs]e
vim | 3 | vim licen | (?:the )?vim licen[cs]e
tcl | 3 | tcl tk licen / tcl licen | tcl (?:tk )?licen[cs]e
xfree86 | 3 | xfree86 | xfree86 licen[cs]e(?: 1 1)?
hpnd | 5 | permission to use copy modify and distribute this software and its documentation | permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted
ntp | 4 | provided that the above copyright notice appear | provided that the above copyright notice appears? in all copies and that both (?:that|the) copyright notice and this permission notice appear
naist | 2 | naist licen | naist licen[cs]e
intel | 2 | intel open source licen / intel simplified software licen | intel (?:open source|simplified software) licen[cs]e
cpal-1.0 | 3 | common public attribution licen | common public attribution licen[cs]e(?: version)?(?: 1 0)?
rpl-1.5 | 3 | reciprocal public licen | reciprocal public licen[cs]e(?: version)?(?: 1 5)?
lppl-1.3c | 4 | latex project public licen | under the conditions of the latex project public licen[cs]e
lppl-1.3c | 3 | latex project public licen / lppl | (?:latex project public licen[cs]e|lppl)(?: version)?(?: 1 3c?)?
mulan-2.0 | 3 | mulan p | mulan (?:psl|permissive software licen[cs]e)(?: v2| version 2)?
upl-1.0 | 3 | universal permissive licen | universal permissive licen[cs]e(?: v| version)?(?: ?1 0)?
blueoak-1.0 | 3 | blue oak model licen | blue oak model licen[cs]e(?: 1 0 0)?
busl-1.1 | 5 | spdx license identifier busl 1 1 | spdx license identifier busl 1 1
busl-1.1 | 3 | business source licen | business source licen[cs]e(?: v| version)?(?: ?1 1)?
sspl-1.0 | 5 | spdx license identifier sspl 1 0 | spdx license identifier sspl 1 0
sspl-1.0 | 3 | server side public licen / sspl | (?:server side public licen[cs]e|sspl)(?: v| version)?(?: ?1(?: 0)?)?
elastic-2.0 | 3 | elastic licen | elastic licen[cs]e(?: v| version)?(?: ?2 0)?
commons-clause | 3 | commons clause | commons clause(?: licen[cs]e)?(?: condition)?(?: v1 0)?
polyform | 3 | polyform | polyform (?:noncommercial|small business|strict|shield|internal use|perimeter|free trial)(?: licen[cs]e)?(?: 1 0 [01])?
confluent | 3 | confluent community licen | confluent community licen[cs]e(?: agreement)?
timescale | 3 | timescale licen | timescale licen[cs]e(?: agreement)?
rail | 3 | open rail / openrail | (?:creativeml )?(?:open rail|openrail)(?: m| s| plus plus m)?(?: licen[cs]e)?
llama | 3 | llama | llama [234](?: [1-3])? community licen[cs]e(?: agreement)?
gemma | 2 | gemma terms of use | gemma terms of use
ai2-impact | 2 | ai2 impact licen | ai2 impact licen[cs]e
free-art | 3 | free art licen / licence art libre | (?:free art licen[cs]e|licence art libre)(?: 1 3)?
against-drm | 2 | against drm licen | against drm licen[cs]e
opl | 3 | open publication licen | open publication licen[cs]e(?: v| version)?(?: ?1 0)?
opl | 3 | open content licen | open content licen[cs]e
oasis | 2 | oasis ipr policy | oasis ipr policy
ietf-trust | 3 | ietf trust | subject to bcp 78 and the ietf trust s legal provisions
ogc | 2 | ogc document licen | ogc document licen[cs]e(?: agreement)?
openpub-news | 3 | may be republished | may be republished (?:online |in print )?(?:for free|with attribution|under)
terms | 2 | terms of service | subject to (?:our|the|these) terms of service
terms | 2 | terms of use | (?:by using this (?:site|website|software)|subject to) (?:.{0,40} )?terms of use
eula | 4 | end user licen | end user licen[cs]e agreement
eula | 3 | eula | eula
proprietary | 4 | proprietary and confidential / confidential and proprietary | (?:proprietary and confidential|confidential and proprietary)(?: information)?
proprietary | 4 | unauthorized | unauthorized (?:copying|reproduction|distribution|use)(?: or (?:copying|reproduction|distribution|use))*(?: of this (?:file|software|document|material|work))?(?: via any medium)? is strictly prohibited
proprietary | 4 | permission / consent | may not be (?:copied|reproduced|redistributed|republished|rewritten|broadcast)(?: (?:or )?(?:copied|reproduced|redistributed|republished|rewritten|broadcast|transmitted|distributed))* (?:.{0,60} )?without (?:the )?(?:prior |express )*(?:written )?(?:permission|consent)
proprietary | 4 | reproduced / copied / distributed / stored / transmitted | no part of this (?:publication|book|document|work|website|software) may be (?:reproduced|copied|distributed|stored|transmitted)
proprietary | 4 | trade secret | contains? trade secrets?
proprietary | 3 | for internal use only | for internal use only
proprietary | 3 | do not distribute | do not distribute
proprietary | 3 | commercial licen | (?:requires?|under|purchase|obtain) (?:a )?commercial licen[cs]e
proprietary | 3 | proprietary licen / proprietary software | proprietary (?:licen[cs]e|software)
proprietary | 3 | all rights not expressly granted | all rights not expressly granted (?:herein )?are reserved
proprietary | 2 | all rights reserved | all rights reserved(?: worldwide)?
proprietary | 2 | alle rechte vorbehalten | alle rechte vorbehalten
proprietary | 2 | tous droits | tous droits (?:de reproduction )?r.serv.s
proprietary | 2 | todos los derechos reservados | todos los derechos reservados
proprietary | 2 | tutti i diritti riservati | tutti i diritti riservati
proprietary | 2 | todos os direitos reservados | todos os direitos reservados
noncommercial | 3 | commercial use only / commercial purposes only / noncommercial use only / noncommercial purposes only / personal use only / personal purposes only | (?:for )?(?:non ?commercial|personal) (?:use|purposes) only
noncommercial | 3 | commercial use | (?:no|not for|prohibits?) commercial use
noncommercial | 3 | research purposes only / academic use only / educational purposes only | (?:for )?(?:research purposes|academic use|educational purposes) only
freeware | 2 | freeware | (?:this (?:software|program) is )?freeware
shareware | 2 | shareware | (?:this (?:software|program) is )?shareware
dual | 4 | licensed under | (?:dual|tri|multi) licensed under
dual | 3 | at your option | (?:licensed|available) under either of .{1,80}? at your option
dual | 3 | choice of | (?:under|of) your choice of (?:the )?licen[cs]es?
hint | 1 | see licen / see the licen | see (?:the )?licen[cs]e(?: file| txt| md)?(?: for (?:details|more information|terms))?
hint | 1 | licen | licen[cs]e (?:agreement|terms|notice|information)
hint | 1 | open source licen | open source licen[cs]es?
hint | 1 | copyright notice | copyright notice
hint | 1 | copyright c | copyright c(?: by)? (?:19|20)[0-9][0-9]
hint | 1 | third party licen / third party notices | third party (?:licen[cs]es?|notices)
hint | 1 | permission is granted | permission is granted
hint | 1 | used with permission / reprinted with permission / reproduced with permission | (?:used|reprinted|reproduced) with permission
"""


#: Words that many texts have, what words begin with at the end of a keyword, and names that a version may
#: follow without a space.
COMMON = frozenset(
    "a above after against an and any applicable are as at be by buy can community conditions content contents copy copying data do document either end files following for free general good have i if "
    "implied in is it itself like may me model modified modify must my name neither new no not of only open or original our part party program project public q received redistribute required same see "
    "service shall should site software source special style terms that the their these third this to under use used user using version versions want was we website will with without work x you your "
    "zero 1 2 3 4 5".split()
)
CUT = frozenset(("licen", "l", "p", "secret", "acknowledg", "gpl", "agpl", "lgpl", "mpl"))
NAMES = ("agpl", "apache", "eupl", "gpl", "lgpl", "mpl", "sspl")


def triggers(keyword: str) -> tuple[str, ...]:
    """Whole words of which every text with a keyword's rule has one: the longest of the keyword's words that few texts
    have; if it has none, the word that nearly all rules have."""
    words = keyword.split()
    if words[-1] in CUT and len(words) > 1 or words[-1] == "licen":
        words.pop()
    rare = [w for w in words if w not in COMMON]
    found = max(rare or ([] if keyword.endswith("licen") else words), key=len, default="")
    if found in NAMES:
        return (found, *(found + v + d for v in ("", "v") for d in "123"))
    return (found,) if found else ("license", "licence", "licenses", "licences")


def table() -> list[tuple[str, int, tuple[str, ...], str]]:
    """(label, rank, keywords, expression) of every signature, in order."""
    rows = [line.split(" | ", 3) for line in SIGNATURES.strip().splitlines()]
    return [(label.strip(), int(rank), tuple(k.strip() for k in words.split(" / ")), expression.strip()) for label, rank, words, expression in rows]
