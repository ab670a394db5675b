"""Signatures of licence texts and notices, written by hand: label, keyword, pattern.

Patterns run over lower-case words with one space between (marks are gone: "2.0" is "2 0",
"licensor's" is "licensor s").  A keyword is whole words that any match contains; a signature is tried
only where they stand.  The order decides between equal detections.  Fixed values.
"""

from __future__ import annotations

#: Sentences that only the text of a licence has.
BODIES = [
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "deal in the software", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell"),
    ("mit", "substantial portions of the software", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "substantial portions of the software", "shall be included in all copies or substantial portions of the software"),
    ("mit-0", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("x11", "x consortium", "the name of the x consortium shall not be used in advertising"),
    ("x11", "advertising or otherwise", "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    ("bsd", "source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code", "redistributions of source code must retain the (?:above )?copyright notice this list of conditions and the following disclaimer"),
    ("bsd-2", "redistributions in binary form", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-3", "endorse or promote products", "neither the name of (?:the )?(?:\\S+ ){1,8}(?:nor|or) the names of (?:its|any|the) contributors may be used to endorse or promote products"),
    ("bsd-3", "endorse or promote products", "may (?:not )?be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4", "advertising materials mentioning", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd-0", "permission to use", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("bsd-clear", "express or implied licenses", "no express or implied licenses to any party s patent rights are granted by this license"),
    ("isc", "permission to use", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("isc", "permission to use", "permission to use copy modify and(?: or)? distribute this software for any purpose"),
    ("hpnd", "permission to use", "permission to use copy modify and distribute this software and its documentation for any purpose"),
    ("apache-2.0", "unless required by applicable law", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "in compliance with the license", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "terms and conditions for use", "terms and conditions for use reproduction and distribution"),
    ("apache-2.0", "grant of patent license", "grant of patent license subject to the terms and conditions of this license each contributor hereby grants to you"),
    ("apache-1.1", "apache software foundation", "this product includes software developed by the apache software foundation"),
    ("gpl", "free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "free software", "(?:this|the) (?:program|file|software|library|package) is free software you can redistribute it and or modify it"),
    ("gpl", "received a copy", "you should have received a copy of the gnu general public license along with"),
    ("gpl", "hope that it will be useful", "(?:this program|it) is distributed in the hope that it will be useful but without any warranty"),
    ("gpl", "freedom to share and change", "the licenses for most software(?: and other practical works)? are designed to take away your freedom to share and change"),
    ("gpl-2.0", "version 2 june 1991", "gnu general public license version 2 june 1991"),
    ("gpl-3.0", "version 3 29 june 2007", "gnu general public license version 3 29 june 2007"),
    ("gpl-2.0", "either version 2", "gnu general public license as published by the free software foundation either version 2"),
    ("gpl-3.0", "either version 3", "gnu general public license as published by the free software foundation either version 3"),
    ("gpl-2.0", "version 2 as published", "gnu general public license version 2 as published by the free software foundation"),
    ("gpl-3.0", "version 3 as published", "gnu general public license version 3 as published by the free software foundation"),
    ("gpl-classpath", "classpath exception", "gnu general public license(?: version 2)?(?: only)? with (?:the )?classpath exception"),
    ("gpl-classpath", "as a special exception", "as a special exception the copyright holders of this library give you permission to link this library"),
    ("gpl-autoconf", "as a special exception", "as a special exception to the gnu general public license if you distribute this file as part of a program that contains a configuration script generated by autoconf"),
    ("gpl-bison", "as a special exception", "as a special exception you may create a larger work that contains part or all of the bison parser skeleton"),
    ("gcc-runtime", "gcc runtime library exception", "gcc runtime library exception"),
    ("lgpl", "received a copy", "you should have received a copy of the gnu lesser general public license along with"),
    ("lgpl", "received a copy", "you should have received a copy of the gnu library general public license along with"),
    ("lgpl", "gnu lesser general public license", "redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("lgpl-2.0", "gnu library general public license", "gnu library general public license version 2"),
    ("lgpl-2.1", "version 2 1 february 1999", "gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-3.0", "additional permissions listed below", "incorporates the terms and conditions of version 3 of the gnu general public license supplemented by the additional permissions listed below"),
    ("agpl", "received a copy", "you should have received a copy of the gnu affero general public license along with"),
    ("agpl", "gnu affero general public license", "redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("agpl-3.0", "version 3 19 november 2007", "gnu affero general public license version 3 19 november 2007"),
    ("mpl-1.1", "subject to the mozilla public license", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1.0", "subject to the mozilla public license", "the contents of this file are subject to the mozilla public license version 1 0"),
    ("mpl-2.0", "source code form", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", "source code form", "this source code form is incompatible with secondary licenses"),
    ("mpl-2.0", "copy of the mpl", "if a copy of the mpl was not distributed with this file you can obtain one"),
    ("epl", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl-1.0", "eclipse public license", "terms of the eclipse public license v1 0"),
    ("epl-2.0", "eclipse public license", "terms of the eclipse public license(?: v)? 2 0"),
    ("edl-1.0", "eclipse distribution license", "eclipse distribution license v(?:ersion)? ?1 0"),
    ("cpl-1.0", "common public license", "common public license(?: version)? (?:v ?)?1 0"),
    ("cddl", "common development and distribution license", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("cddl", "subject to the terms of the common development", "subject to the terms of the common development and distribution license the license you may not use this file"),
    ("zlib", "this software is provided", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", "this software is provided", "this software is provided as is without any express or implied warranty"),
    ("zlib", "origin of this software", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("libpng", "png reference library", "the png reference library is supplied as is"),
    ("libpng", "pnggroup", "pnggroup and contributing authors"),
    ("boost-1.0", "permission is hereby granted", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("boost-1.0", "boost software license", "distributed under the boost software license version 1 0"),
    ("boost-1.0", "machine executable object code", "derivative works are solely in the form of machine executable object code generated by a source language processor"),
    ("unlicense", "unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "relinquishment in perpetuity", "we intend this dedication to be an overt act of relinquishment in perpetuity"),
    ("wtfpl", "do what the fuck", "you just do what the fuck you want to"),
    ("wtfpl-2.0", "do what the fuck", "do what the fuck you want to public license version 2"),
    ("beerware", "beer ware license", "the beer ware license"),
    ("beerware", "buy me a beer", "you can buy me a beer in return"),
    ("artistic", "copyright holder maintains", "the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control"),
    ("artistic-2.0", "artistic license", "the artistic license 2 0"),
    ("perl", "same terms as perl", "(?:redistribute it and or modify it )?under the same terms as perl(?: itself)?"),
    ("ruby", "same terms as ruby", "under the same terms as ruby(?: itself)?"),
    ("ruby", "ruby license", "ruby license"),
    ("openssl", "openssl project", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("openssl", "eric young", "this product includes cryptographic software written by eric young"),
    ("openssl", "openssl license", "openssl license"),
    ("ssleay", "ssleay license", "original ssleay license"),
    ("php-3.0", "php software", "this product includes php software freely available from"),
    ("php-3.01", "php license", "php license version 3 01"),
    ("php", "php license", "php license"),
    ("zpl-2.1", "zope public license", "zope public license(?: zpl)? version 2 1"),
    ("zpl", "zope public license", "zope public license"),
    ("ncsa", "university of illinois", "university of illinois(?: ncsa)? open source license"),
    ("ncsa", "deal with the software", "to deal with the software without restriction"),
    ("psf", "psf is making python available", "psf is making python available to licensee on an as is basis"),
    ("psf-2.0", "python software foundation license", "python software foundation license version 2"),
    ("python-cnri", "cnri open source", "cnri open source(?: gpl compatible)? license agreement"),
    ("w3c", "w3c software", "w3c software (?:and document )?(?:notice and )?license"),
    ("w3c", "w3c document license", "w3c document license"),
    ("icu", "icu license", "icu license"),
    ("unicode", "unicode license", "unicode license(?: v3)?"),
    ("unicode", "unicode data files", "free of charge to any person obtaining a copy of(?: the)? unicode data files"),
    ("curl", "permission to use", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("ijg", "independent jpeg group", "this software is based in part on the work of the independent jpeg group"),
    ("freetype", "freetype project", "portions of this software are copyright (?:\\S+ )?the freetype project"),
    ("freetype", "freetype project license", "the freetype project license"),
    ("vim", "vim license", "vim license"),
    ("qpl-1.0", "q public license", "q public license(?: version 1 0)?"),
    ("sleepycat", "sleepycat license", "sleepycat license"),
    ("sleepycat", "accompanying software that uses", "complete source code for the db software and any accompanying software that uses the db software"),
    ("json", "good not evil", "the software shall be used for good not evil"),
    ("cecill", "cecill", "cecill (?:free software )?license(?: agreement)?"),
    ("cecill-b", "cecill b", "cecill b (?:free software )?license(?: agreement)?"),
    ("cecill-c", "cecill c", "cecill c (?:free software )?license(?: agreement)?"),
    ("osl-3.0", "open software license", "open software license version 3 0"),
    ("osl", "open software license", "open software license"),
    ("afl-3.0", "academic free license", "academic free license version 3 0"),
    ("afl", "academic free license", "academic free license"),
    ("ecl-2.0", "educational community license", "educational community license version 2 0"),
    ("ecl", "educational community license", "educational community license"),
    ("rpl", "reciprocal public license", "reciprocal public license"),
    ("cpal-1.0", "common public attribution license", "common public attribution license(?: version)? 1 0"),
    ("apsl-2.0", "apple public source license", "apple public source license version 2 0"),
    ("apsl", "apple public source license", "apple public source license"),
    ("npl", "netscape public license", "netscape public license"),
    ("spl", "sun public license", "sun public license"),
    ("ipl-1.0", "ibm public license", "ibm public license(?: version 1 0)?"),
    ("intel", "intel open source license", "intel open source license"),
    ("ms-pl", "microsoft public license", "microsoft public license ms pl"),
    ("ms-rl", "microsoft reciprocal license", "microsoft reciprocal license"),
    ("eupl-1.2", "licensed under the eupl", "licensed under the eupl(?: version)? 1 2"),
    ("eupl-1.2", "european union public licence", "european union public licence v ?1 2"),
    ("mulan-2", "mulan psl v2", "mulan psl v2"),
    ("mulan-2", "mulan permissive software license", "mulan permissive software license version 2"),
    ("upl-1.0", "universal permissive license", "universal permissive license(?: version| v)? 1 0"),
    ("blueoak-1.0", "blue oak model license", "blue oak model license(?: version)? 1 0 0"),
    ("bsl-1.1", "business source license", "business source license(?: version)? 1 1"),
    ("bsl-1.1", "change date", "on the change date or the fourth anniversary of the first publicly available distribution"),
    ("sspl-1.0", "server side public license", "server side public license(?: version 1| v ?1)?"),
    ("elastic-2.0", "elastic license", "elastic license(?: version)? 2 0"),
    ("elastic", "elastic license", "elastic license"),
    ("commons-clause", "commons clause", "commons clause license condition"),
    ("polyform-nc", "polyform noncommercial license", "polyform noncommercial license"),
    ("polyform-sb", "polyform small business license", "polyform small business license"),
    ("rail", "responsible ai license", "(?:open )?responsible ai license"),
    ("openrail-m", "creativeml open rail m", "creativeml open rail m"),
    ("llama", "llama", "llama (?:2|3|3 1) community license(?: agreement)?"),
    ("odbl-1.0", "open database license", "open database license(?: odbl)?(?: v(?:ersion)? ?1 0)?"),
    ("odc-by-1.0", "open data commons attribution license", "open data commons attribution license"),
    ("pddl-1.0", "public domain dedication and license", "(?:odc|open data commons) public domain dedication and license"),
    ("cdla", "community data license agreement", "community data license agreement(?: permissive| sharing)?"),
    ("ogl-uk", "open government licence", "open government licence(?: v(?:ersion)? ?[123](?: 0)?)?"),
    ("dl-de", "datenlizenz deutschland", "datenlizenz deutschland(?: namensnennung| zero)?"),
    ("etalab", "licence ouverte", "licence ouverte(?: open licence)?"),
    ("cc-by-4.0", "creative commons attribution 4 0", "creative commons attribution 4 0 international(?: public license)?"),
    ("cc-by-sa-4.0", "creative commons attribution sharealike 4 0", "creative commons attribution sharealike 4 0 international(?: public license)?"),
    ("cc-by-nc-4.0", "creative commons attribution noncommercial 4 0", "creative commons attribution noncommercial 4 0 international(?: public license)?"),
    ("cc-by-nd-4.0", "creative commons attribution noderivatives 4 0", "creative commons attribution noderivatives 4 0 international(?: public license)?"),
    ("cc-by-nc-sa-4.0", "creative commons attribution noncommercial sharealike", "creative commons attribution noncommercial sharealike 4 0 international(?: public license)?"),
    ("cc-by-nc-nd-4.0", "creative commons attribution noncommercial noderivatives", "creative commons attribution noncommercial noderivatives 4 0 international(?: public license)?"),
    ("cc-by", "creativecommons org licenses by", "creativecommons org licenses by"),
    ("cc-by-sa", "creativecommons org licenses by sa", "creativecommons org licenses by sa"),
    ("cc-by-nc", "creativecommons org licenses by nc", "creativecommons org licenses by nc"),
    ("cc-by-nd", "creativecommons org licenses by nd", "creativecommons org licenses by nd"),
    ("cc-by-nc-sa", "creativecommons org licenses by nc sa", "creativecommons org licenses by nc sa"),
    ("cc-by-nc-nd", "creativecommons org licenses by nc nd", "creativecommons org licenses by nc nd"),
    ("cc0-1.0", "creativecommons org publicdomain zero", "creativecommons org publicdomain zero 1 0"),
    ("cc0-1.0", "dedicated the work to the public domain", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0-1.0", "waived all copyright", "has waived all copyright and related or neighboring rights"),
    ("gfdl", "permission is granted to copy", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", "no invariant sections", "with no invariant sections no front cover texts and no back cover texts"),
    ("ofl-1.1", "sil open font license", "this font software is licensed under the sil open font license version 1 1"),
    ("ofl", "reserved font name", "with reserved font name"),
    ("postgresql", "permission to use", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("public-domain", "public domain", "(?:placed|released|dedicated|put) (?:in|into|to) the public domain"),
    ("public-domain", "public domain", "(?:this (?:file|code|software|work|program|text) is )?(?:hereby )?in the public domain"),
    ("public-domain", "author disclaims copyright", "the author disclaims copyright to this source code"),
    ("public-domain", "united states government", "this (?:software|work) is a work of the united states government"),
    ("proprietary", "all rights reserved", "all rights reserved"),
    ("proprietary", "proprietary and confidential", "proprietary and confidential"),
    ("proprietary", "confidential and proprietary", "confidential and proprietary"),
    ("proprietary", "unauthorized copying", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "without the prior written permission", "(?:reproduced|distributed|copied|transmitted) (?:\\S+ ){0,12}without the prior written permission"),
    ("proprietary", "for internal use only", "for internal use only"),
    ("proprietary", "end user license agreement", "end user license agreement"),
    ("proprietary", "trade secret", "contains (?:\\S+ ){0,6}trade secret"),
    ("freeware", "freeware", "(?:this software|this program|it) is freeware"),
    ("shareware", "shareware", "(?:this software|this program|it) is shareware"),
]
