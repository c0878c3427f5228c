"""What licenses and notices say, written out rule by rule.

Each row: label, priority, weight, keywords that must all stand in the text, pattern. Patterns are over the
words of a text in lower case, parted by single spaces. Of rules that overlap the one with the higher
priority wins: 9 for the words that only one license has, 8 for grants and headers, 7 for clauses that
some licenses share, 5 for short remarks.
"""

#: Up to a dozen words that differ from text to text, such as the name of a holder.
_NAMES = r"(?:[^ ]+ ){1,12}"
_L = "licen[cs]e"

SIGNATURES = (
    # GNU licenses: headers, grants and exceptions
    ("gpl", 8, 1.0, ("this program is free software", "general public"), rf"this program is free software you can redistribute it and or modify it under the terms of the gnu general public {_L}"),
    ("lgpl", 8, 1.0, ("this library is free software", "general public"), rf"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public {_L}"),
    ("lgpl", 8, 1.0, ("free software", "lesser general public"), rf"(?:program|software|file) is free software you can redistribute it and or modify it under the terms of the gnu lesser general public {_L}"),
    ("agpl", 8, 1.0, ("free software", "affero"), rf"(?:program|software|file) is free software you can redistribute it and or modify it under the terms of the gnu affero general public {_L}"),
    ("gpl", 7, 0.9, ("this program is distributed in the hope",), r"this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("lgpl", 7, 0.9, ("this library is distributed in the hope",), r"this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl", 8, 0.95, ("you should have received a copy of the gnu general",), rf"you should have received a copy of the gnu general public {_L}"),
    ("lgpl", 8, 0.95, ("you should have received a copy of the gnu l",), rf"you should have received a copy of the gnu (?:lesser|library) general public {_L}"),
    ("agpl", 8, 0.95, ("you should have received a copy of the gnu affero",), rf"you should have received a copy of the gnu affero general public {_L}"),
    ("gpl", 9, 1.0, ("designed to take away your freedom",), r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl", 9, 1.0, ("free copyleft license for software",), rf"the gnu general public {_L} is a free copyleft {_L} for software and other kinds of works"),
    ("agpl", 9, 1.0, ("cooperation with the community",), r"specifically designed to ensure cooperation with the community in the case of network server software"),
    ("lgpl", 9, 1.0, ("incorporates the terms and conditions of version 3",), rf"this version of the gnu lesser general public {_L} incorporates the terms and conditions of version 3"),
    ("gpl", 7, 0.9, ("carry prominent notices stating that you changed",), r"you must cause the modified files to carry prominent notices stating that you changed the files"),
    ("gpl", 7, 0.9, ("activities other than copying",), rf"activities other than copying distribution and modification are not covered by this {_L}"),
    ("lgpl", 9, 0.95, ("work that uses the library",), r"a program that contains no derivative of any portion of the library but is designed to work with the library"),
    ("gnu-license-text", 7, 0.8, ("verbatim copies of this license document",), rf"everyone is permitted to copy and distribute verbatim copies of this {_L} document but changing it is not allowed"),
    ("gpl-classpath-exception", 9, 1.0, ("statically or dynamically with other modules",), r"linking this library statically or dynamically with other modules is making a combined work based on this library"),
    ("gpl-classpath-exception", 9, 1.0, ("link this library with independent modules",), r"give you permission to link this library with independent modules to produce an executable"),
    ("gcc-runtime-exception", 9, 1.0, ("gcc runtime library exception",), r"gcc runtime library exception"),
    ("bison-exception", 9, 1.0, ("bison parser skeleton",), r"as a special exception you may create a larger work that contains part or all of the bison parser skeleton"),
    ("autoconf-exception", 9, 1.0, ("configuration script generated by autoconf",), r"if you distribute this file as part of a program that contains a configuration script generated by autoconf"),
    ("libtool-exception", 9, 1.0, ("built using gnu libtool",), r"if you distribute this file as part of a program or library that is built using gnu libtool"),
    ("font-exception", 9, 1.0, ("embed this font",), r"if you create a document which uses this font and embed this font"),
    ("linux-syscall-note", 9, 1.0, ("normal system calls",), r"does not cover user programs that use kernel services by normal system calls"),
    ("openssl-exception", 9, 1.0, ("link the code of portions of this program with the openssl",), r"permission to link the code of portions of this program with the openssl library"),
    ("gfdl", 8, 1.0, ("free documentation",), rf"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation {_L}"),
    ("gfdl", 8, 0.95, ("no invariant sections",), r"with no invariant sections no front cover texts and no back cover texts"),
    ("sspl", 9, 1.0, ("third parties as a service",), r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("sspl", 8, 0.95, ("server side public",), rf"server side public {_L}"),
    # Apache
    ("apache", 8, 1.0, ("except in compliance with the license", "apache"), rf"licensed under the apache {_L} version 2 0 the {_L} you may not use this file except in compliance with the {_L}"),
    ("apache", 8, 1.0, ("www apache org licenses",), rf"you may obtain a copy of the {_L} at https? www apache org licenses {_L} 2 0"),
    ("apache", 7, 0.9, ("unless required by applicable law",), rf"unless required by applicable law or agreed to in writing software distributed under the {_L} is distributed on an as is basis without warranties or conditions of any kind"),
    ("apache", 9, 1.0, ("contributor license agreements",), rf"licensed to the apache software foundation (?:asf )?under one or more contributor {_L} agreements"),
    ("apache", 9, 1.0, ("software developed by the apache",), r"this product includes software developed by the apache (?:software foundation|group)"),
    ("apache", 9, 0.95, ("may not be called apache",), r"products derived from this software may not be called apache"),
    ("apache", 7, 0.9, ("each contributor hereby grants to you a perpetual",), rf"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright {_L}"),
    ("llvm-exception", 9, 1.0, ("llvm exceptions",), rf"(?:apache {_L} v2 0 )?with llvm exceptions?"),
    ("ecl", 8, 1.0, ("educational community",), rf"educational community {_L} version 2 0"),
    # MIT and its relatives
    ("mit", 8, 1.0, ("free of charge to any person obtaining a copy", "deal in the software"), r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", 7, 0.95, ("use copy modify merge publish",), r"the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", 7, 0.9, ("all copies or substantial portions",), r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", 7, 0.85, ("fitness for a particular purpose and noninfringement",), r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit", 7, 0.85, ("action of contract tort or otherwise",), r"in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise"),
    ("json", 9, 1.0, ("good not evil",), r"the software shall be used for good not evil"),
    ("x11", 9, 0.95, ("except as contained in this notice",), rf"except as contained in this notice the names? of {_NAMES}shall not be used in advertising or otherwise to promote the sale use or other dealings"),
    ("mit-0", 9, 1.0, ("mit no attribution",), r"mit no attribution"),
    ("hpnd", 8, 0.95, ("software and its documentation for any purpose",), r"permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose (?:and without fee )?is hereby granted (?:without fee )?provided that"),
    ("hpnd", 7, 0.85, ("without specific written prior permission",), rf"that the names? of {_NAMES}not be used in advertising or publicity pertaining to distribution of the software without specific written prior permission"),
    ("postgresql", 9, 1.0, ("without a written agreement",), r"for any purpose without fee and without a written agreement is hereby granted"),
    ("ncsa", 9, 1.0, ("deal with the software without restriction",), r"to deal with the software without restriction including without limitation the rights"),
    ("ncsa", 8, 0.95, ("ncsa open source",), rf"(?:university of illinois )?ncsa open source {_L}"),
    ("unicode", 9, 1.0, ("unicode data files",), r"permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    ("tcl", 9, 1.0, ("the authors hereby grant permission to use",), rf"the authors hereby grant permission to use copy modify distribute and {_L} this software and its documentation for any purpose"),
    ("isc", 8, 0.95, ("and or distribute this software for any purpose", "permission notice appear in all copies"), r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd", 9, 1.0, ("fee is hereby granted the software is provided",), r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("isc", 7, 0.85, ("the author disclaims all warranties",), r"the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("curl", 8, 0.95, ("curl and libcurl",), r"curl and libcurl are (?:licensed|distributed)"),
    ("w3c", 9, 1.0, ("you the licensee agree that you have read",), r"by obtaining (?:using and or copying )?this (?:work|software) you the licensee agree that you have read understood and will comply"),
    ("bzip2", 9, 0.9, ("product documentation would be appreciated",), r"if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required"),
    # BSD
    ("bsd", 7, 0.95, ("redistributions of source code must retain",), r"redistributions of source code must retain the (?:above )?copyright notice this list of conditions and the following disclaimer"),
    ("bsd", 7, 0.95, ("redistributions in binary form must reproduce",), r"redistributions in binary form must reproduce the (?:above )?copyright notice this list of conditions and the following disclaimer"),
    ("bsd-3-clause", 9, 1.0, ("endorse or promote products derived from this software",), rf"neither the names? of {_NAMES}(?:nor|or) the names of (?:its|their|any) contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", 9, 1.0, ("all advertising materials mentioning",), r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", 7, 0.85, ("any express or implied warranties",), r"this software is provided by (?:the )?(?:[^ ]+ ){1,8}as is and any express or implied warranties"),
    ("bsd", 7, 0.8, ("procurement of substitute goods",), r"direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services"),
    ("bsd-3-clause-clear", 9, 1.0, ("no express or implied licenses to any party",), r"no express or implied licenses to any party s patent rights are granted by this"),
    ("bsd-patent", 9, 1.0, ("patent license to make have made use", "redistribution"), r"each copyright holder and contributor hereby grants to those receiving rights under this license"),
    ("beerware", 9, 1.0, ("you can do whatever you want with this stuff",), r"as long as you retain this notice you can do whatever you want with this stuff"),
    # Mozilla, Eclipse and others with file copyleft
    ("mpl", 8, 1.0, ("this source code form is subject",), rf"this source code form is subject to the terms of the mozilla public {_L}"),
    ("mpl", 8, 0.95, ("a copy of the mpl was not distributed",), r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl", 8, 1.0, ("the contents of this file are subject to the mozilla",), rf"the contents of this file are subject to the mozilla public {_L}"),
    ("mpl", 9, 1.0, ("incompatible with secondary licenses",), r"this source code form is incompatible with secondary licenses"),
    ("mpl-gpl-lgpl", 9, 1.0, ("alternatively the contents of this file may be used",), rf"alternatively the contents of this file may be used under the terms of (?:either )?the gnu (?:lesser )?general public {_L}"),
    ("epl", 8, 1.0, ("accompanying materials are made available", "eclipse"), rf"this program and the accompanying materials are made available under the terms of the eclipse public {_L}"),
    ("edl", 8, 1.0, ("eclipse distribution",), rf"eclipse distribution {_L}"),
    ("epl", 7, 0.9, ("accompanying program is provided", "eclipse"), rf"the accompanying program is provided under the terms of this eclipse public {_L}"),
    ("cpl", 7, 0.9, ("accompanying program is provided", "common public"), rf"the accompanying program is provided under the terms of this common public {_L}"),
    ("ipl", 7, 0.9, ("accompanying program is provided", "ibm public"), rf"the accompanying program is provided under the terms of this ibm public {_L}"),
    ("cddl", 8, 1.0, ("subject to the terms of the common development",), rf"the contents of this file are subject to the terms of the common development and distribution {_L}"),
    ("cddl", 9, 1.0, ("opensolaris license",), rf"you can obtain a copy of the {_L} at usr src opensolaris {_L}"),
    ("eupl", 8, 1.0, ("licensed under the eupl",), r"licensed under the eupl"),
    ("eupl", 9, 1.0, ("european union public", "applies to the work"), rf"this european union public {_L} the eupl applies to the work"),
    ("osl", 8, 0.95, ("open software license",), rf"(?:licensed under the )?open software {_L} version 3 0"),
    ("afl", 8, 0.95, ("academic free license",), rf"(?:licensed under the )?academic free {_L}"),
    ("qpl", 8, 0.95, ("q public license",), rf"q public {_L}"),
    ("ms-pl", 8, 0.95, ("if you use the software you accept this license",), rf"this {_L} governs use of the accompanying software if you use the software you accept this {_L}"),
    ("ms-rl", 9, 1.0, ("reciprocal grants",), r"reciprocal grants for any file you distribute that contains code from the software"),
    ("ms-rl", 8, 0.95, ("microsoft reciprocal",), rf"microsoft reciprocal {_L}"),
    # Perl, Python, PHP, Ruby and other projects
    ("artistic", 9, 1.0, ("conditions under which a package may be copied",), r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic", 9, 1.0, ("given free software package may be copied",), rf"this {_L} establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("perl", 8, 1.0, ("same terms as perl",), r"(?:redistribute it and or modify it |is free software )?under the same terms as (?:the )?perl(?: 5| itself)?"),
    ("python", 9, 1.0, ("psf is making python available",), r"psf is making python available to licensee on an as is basis"),
    ("python", 9, 1.0, ("license agreement is between the python",), rf"this {_L} agreement is between the python software foundation"),
    ("php", 9, 1.0, ("this product includes php software",), r"this product includes php software freely available from"),
    ("php", 9, 0.95, ("the name php must not be used",), r"the name php must not be used to endorse or promote products"),
    ("openssl", 9, 1.0, ("for use in the openssl toolkit",), r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", 9, 1.0, ("cryptographic software written by eric young",), r"this product includes cryptographic software written by eric young"),
    ("ruby", 9, 1.0, ("ruby is copyrighted free software",), r"ruby is copyrighted free software"),
    ("ruby", 8, 0.95, ("same terms as ruby",), r"under the same terms as ruby"),
    ("vim", 9, 1.0, ("vim is charityware",), r"vim is charityware"),
    ("zlib", 8, 1.0, ("without any express or implied warranty", "held liable"), r"this software is provided as is without any express or implied warranty in no event will the authors? be held liable for any damages arising from the use of this software"),
    ("zlib", 9, 1.0, ("origin of this software must not be misrepresented",), r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", 9, 0.95, ("altered source versions must be plainly marked",), r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("libpng", 9, 1.0, ("the png reference library is supplied",), r"the png reference library is supplied as is"),
    ("boost", 9, 1.0, ("any person or organization obtaining a copy",), rf"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this {_L}"),
    ("icu", 8, 0.95, ("international business machines corporation and others", "icu"), rf"icu {_L} icu 1 8 1 and later"),
    ("ijg", 9, 0.95, ("independent jpeg group",), r"this software is based in part on the work of the independent jpeg group"),
    # No rights kept
    ("unlicense", 9, 1.0, ("free and unencumbered software",), r"this is free and unencumbered software released into the public domain"),
    ("unlicense", 8, 0.95, ("anyone is free to copy modify publish",), r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", 9, 1.0, ("changing it is allowed as long as the name",), rf"everyone is permitted to copy and distribute verbatim or modified copies of this {_L} document and changing it is allowed as long as the name is changed"),
    ("wtfpl", 9, 1.0, ("you just do what the fuck",), r"you just do what the fuck you want to"),
    ("public-domain", 8, 0.9, ("disclaims copyright",), r"the authors? (?:hereby )?disclaims? copyright to this source code"),
    ("sqlite-blessing", 9, 1.0, ("here is a blessing",), r"in place of a legal notice here is a blessing"),
    ("public-domain", 7, 0.85, ("in the public domain",), r"this (?:work|file|code|software|program) is in the public domain"),
    ("cc0", 9, 1.0, ("waived all copyright",), r"has waived all copyright and related or neighboring rights"),
    ("cc0", 9, 1.0, ("dedicated the work to the public domain",), r"the person who associated a work with this deed has dedicated the work to the public domain"),
    # Creative Commons and open data
    ("cc-by", 8, 0.95, ("work is licensed under a creative commons attribution",), rf"this work is licensed under a creative commons attribution (?:\d \d )?(?:international |unported |generic )?{_L}"),
    ("cc-by-sa", 8, 1.0, ("work is licensed under a creative commons attribution share",), rf"this work is licensed under a creative commons attribution share ?alike (?:\d \d )?(?:international |unported |generic )?{_L}"),
    ("cc-by-nc", 8, 1.0, ("work is licensed under a creative commons attribution non",), rf"this work is licensed under a creative commons attribution non ?commercial (?:\d \d )?(?:international |unported |generic )?{_L}"),
    ("cc-by-nc-sa", 8, 1.0, ("work is licensed under a creative commons attribution non",), rf"this work is licensed under a creative commons attribution non ?commercial share ?alike (?:\d \d )?(?:international |unported |generic )?{_L}"),
    ("cc-by-nd", 8, 1.0, ("work is licensed under a creative commons attribution no",), rf"this work is licensed under a creative commons attribution no ?deriv(?:ative)?s? (?:\d \d )?(?:international |unported |generic )?{_L}"),
    ("cc-by", 7, 0.9, ("you must give appropriate credit",), rf"you must give appropriate credit provide a link to the {_L} and indicate if changes were made"),
    ("cc-by-sa", 7, 0.9, ("distribute your contributions under the same license",), rf"if you remix transform or build upon the material you must distribute your contributions under the same {_L}"),
    ("cc-by-nc", 7, 0.9, ("may not use the material for commercial purposes",), r"you may not use the material for commercial purposes"),
    ("cc-by-nd", 7, 0.9, ("may not distribute the modified material",), r"if you remix transform or build upon the material you may not distribute the modified material"),
    ("cc-by", 7, 0.85, ("creativecommons org licenses by ",), r"creativecommons org licenses by \d \d"),
    ("cc-by-sa", 8, 0.95, ("creativecommons org licenses by sa",), r"creativecommons org licenses by sa \d \d"),
    ("cc-by-nc", 8, 0.95, ("creativecommons org licenses by nc ",), r"creativecommons org licenses by nc \d \d"),
    ("cc-by-nc-sa", 8, 0.95, ("creativecommons org licenses by nc sa",), r"creativecommons org licenses by nc sa \d \d"),
    ("cc-by-nc-nd", 8, 0.95, ("creativecommons org licenses by nc nd",), r"creativecommons org licenses by nc nd \d \d"),
    ("cc0", 8, 0.95, ("creativecommons org publicdomain zero",), r"creativecommons org publicdomain zero 1 0"),
    ("odbl", 8, 1.0, ("made available under the open database",), rf"is made available under the open database {_L}"),
    ("odc-by", 8, 1.0, ("open data commons attribution",), rf"open data commons attribution {_L}"),
    ("pddl", 8, 1.0, ("public domain dedication and license",), rf"public domain dedication and {_L}"),
    ("cdla", 8, 1.0, ("community data license agreement",), rf"community data {_L} agreement (?:permissive|sharing)"),
    ("ofl", 8, 1.0, ("this font software is licensed",), rf"this font software is licensed under the sil open font {_L}"),
    ("ofl", 9, 1.0, ("the fonts and derivatives",), rf"the fonts and derivatives however cannot be released under any other type of {_L}"),
    ("ubuntu-font", 8, 1.0, ("ubuntu font",), rf"ubuntu font {_L}"),
    # Source that may be read but not used freely
    ("busl", 8, 1.0, ("business source license",), rf"business source {_L}(?: 1 1)?"),
    ("busl", 9, 0.95, ("additional use grant",), r"additional use grant"),
    ("elastic", 8, 1.0, ("elastic license",), rf"elastic {_L}(?: 2 0)?"),
    ("elastic", 9, 0.95, ("hosted or managed service",), r"you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", 8, 1.0, ("commons clause",), rf"commons clause {_L} condition"),
    ("commons-clause", 9, 1.0, ("grant to you the right to sell the software",), rf"the {_L} does not (?:include and the {_L} does not )?grant to you the right to sell the software"),
    ("polyform", 8, 1.0, ("polyform",), rf"polyform (?:noncommercial|small business|shield|strict|internal use|perimeter|free trial) {_L}"),
    ("rail", 8, 0.95, ("responsible ai license",), rf"responsible ai {_L}s?"),
    ("fair-source", 8, 0.95, ("functional source license",), rf"functional source {_L}"),
    # Two at a time
    ("dual-license", 8, 0.9, ("dual licensed under",), r"dual licensed under"),
    ("apache-or-mit", 9, 1.0, ("licensed under either of", "apache"), rf"licensed under either of (?:the )?apache {_L} (?:version 2 0 )?(?:[^ ]+ ){{0,10}}or (?:the )?mit {_L}"),
    ("apache-or-mit", 9, 0.95, ("mit or apache 2 0",), r"mit or apache 2 0"),
    ("apache-or-mit", 9, 0.95, ("apache 2 0 or mit",), r"apache 2 0 or mit"),
    ("dual-license", 7, 0.8, ("under your choice of",), rf"(?:available|licensed|released) under your choice of (?:[^ ]+ ){{1,8}}{_L}"),
    # Closed
    ("proprietary", 8, 0.95, ("unauthorized copying of this file",), r"unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", 7, 0.9, ("proprietary and confidential",), r"proprietary and confidential"),
    ("proprietary", 7, 0.9, ("confidential and proprietary",), r"confidential and proprietary"),
    ("proprietary", 7, 0.9, ("reverse engineer decompile or disassemble",), r"(?:may|shall|will) not reverse engineer decompile or disassemble"),
    ("eula", 7, 0.9, ("end user license agreement",), rf"end user {_L} agreement"),
    ("proprietary", 7, 0.85, ("no part of this publication may be reproduced",), r"no part of this publication may be reproduced"),
    ("non-commercial", 5, 0.7, ("commercial use only",), r"for non ?commercial use only"),
    ("non-commercial", 5, 0.7, ("academic use only",), r"for (?:research and )?academic use only"),
    ("evaluation-only", 5, 0.7, ("evaluation purposes only",), r"for evaluation purposes only"),
    ("all-rights-reserved", 5, 0.7, ("copyright", "all rights reserved"), r"copyright (?:c )?(?:\d{4} )?(?:[^ ]+ ){0,8}all rights reserved"),
)
