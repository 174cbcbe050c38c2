"""Public licence notices, as their publishers print them.

Each entry is (label, parts, mandatory key phrases). Parts are the stretches of
text between what every user fills in (names, years); key phrases stand in one of
the parts. ``EXTENDS`` names notices that hold another's text whole.
"""

_BSD_INTRO = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution.")
_BSD_DISCLAIMER = (
    "ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.")
_BSD_LIABILITY = (
    "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
    "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files (the Software), to deal in the Software "
    "without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
    "to whom the Software is furnished to do so")
_MIT_NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.")
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
    "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT.")
_GNU_WARRANTY = (
    "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
    "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the")

TEMPLATES = (
    # single sentences that name a licence
    ("mit-reference", ("Released under the MIT License.",), ("mit license",)),
    ("apache-2.0-reference", ("Licensed under the Apache License, Version 2.0.",),
     ("apache license version 2 0",)),
    ("gpl-3.0-reference", ("This work is licensed under the GNU General Public License, version 3.",),
     ("gnu general public license version 3",)),
    ("cc-by-4.0-reference",
     ("This work is licensed under a Creative Commons Attribution 4.0 International License.",),
     ("creative commons attribution 4 0 international",)),
    ("cc-by-sa-4.0-reference",
     ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
      "License.",), ("creative commons attribution sharealike 4 0 international",)),
    ("cc-by-nc-4.0-reference",
     ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
      "License.",), ("creative commons attribution noncommercial 4 0 international",)),
    # notices
    ("mit-text", (_MIT_GRANT, _MIT_NOTICE, _MIT_WARRANTY),
     ("permission is hereby granted free of charge",
      "shall be included in all copies or substantial portions")),
    ("mit-0", (_MIT_GRANT + ".", _MIT_WARRANTY), ("permission is hereby granted free of charge",)),
    ("x11",
     (_MIT_GRANT, _MIT_NOTICE, _MIT_WARRANTY,
      "shall not be used in advertising or otherwise to promote the sale, use or other dealings in "
      "this Software without prior written authorization from"),
     ("permission is hereby granted free of charge", "promote the sale use or other dealings")),
    ("apache-2.0-notice",
     ("Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
      "except in compliance with the License. You may obtain a copy of the License at",
      "Unless required by applicable law or agreed to in writing, software distributed under the "
      "License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
      "either express or implied. See the License for the specific language governing "
      "permissions and limitations under the License."),
     ("without warranties or conditions of any kind",)),
    ("gpl-2.0-notice",
     ("you can redistribute it and/or modify it under the terms of the GNU General Public License "
      "as published by the Free Software Foundation; either version 2 of the License, or (at your "
      "option) any later version.", _GNU_WARRANTY + " GNU General Public License for more details."),
     ("gnu general public license as published by the free software foundation", "version 2 of the license")),
    ("gpl-3.0-notice",
     ("you can redistribute it and/or modify it under the terms of the GNU General Public License "
      "as published by the Free Software Foundation, either version 3 of the License, or (at your "
      "option) any later version.", _GNU_WARRANTY + " GNU General Public License for more details."),
     ("gnu general public license as published by the free software foundation", "version 3 of the license")),
    ("lgpl-2.1-notice",
     ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
      "License as published by the Free Software Foundation; either version 2.1 of the License, or "
      "(at your option) any later version.",
      _GNU_WARRANTY + " GNU Lesser General Public License for more details."),
     ("gnu lesser general public license as published by the free software foundation",
      "version 2 1 of the license")),
    ("lgpl-3.0-notice",
     ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
      "License as published by the Free Software Foundation, either version 3 of the License, or "
      "(at your option) any later version.",
      _GNU_WARRANTY + " GNU Lesser General Public License for more details."),
     ("gnu lesser general public license as published by the free software foundation",
      "version 3 of the license")),
    ("agpl-3.0-notice",
     ("you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
      "License as published by the Free Software Foundation, either version 3 of the License, or "
      "(at your option) any later version.",
      _GNU_WARRANTY + " GNU Affero General Public License for more details."),
     ("gnu affero general public license as published by the free software foundation",)),
    ("fdl-1.3-notice",
     ("Permission is granted to copy, distribute and/or modify this document under the terms of the "
      "GNU Free Documentation License, Version 1.3 or any later version published by the Free "
      "Software Foundation; with no Invariant Sections, no Front-Cover Texts, and no Back-Cover "
      "Texts.",), ("gnu free documentation license",)),
    ("bsd-2-clause", (_BSD_INTRO, _BSD_DISCLAIMER, _BSD_LIABILITY),
     ("redistribution and use in source and binary forms",)),
    ("bsd-3-clause",
     (_BSD_INTRO, "Neither the name of",
      "nor the names of its contributors may be used to endorse or promote products derived from "
      "this software without specific prior written permission.", _BSD_DISCLAIMER, _BSD_LIABILITY),
     ("redistribution and use in source and binary forms", "endorse or promote products derived")),
    ("bsd-4-clause",
     (_BSD_INTRO, "All advertising materials mentioning features or use of this software must "
      "display the following acknowledgement: This product includes software developed by",
      _BSD_DISCLAIMER, _BSD_LIABILITY),
     ("redistribution and use in source and binary forms", "all advertising materials mentioning features")),
    ("isc",
     ("Permission to use, copy, modify, and/or distribute this software for any purpose with or "
      "without fee is hereby granted, provided that the above copyright notice and this "
      "permission notice appear in all copies.",
      "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
      "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL "
      "THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
      "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS"),
     ("for any purpose with or without fee", "permission notice appear in all copies")),
    ("0bsd",
     ("Permission to use, copy, modify, and/or distribute this software for any purpose with or "
      "without fee is hereby granted. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL "
      "WARRANTIES",), ("without fee is hereby granted the software is provided",)),
    ("zlib",
     ("This software is provided as-is, without any express or implied warranty. In no event will "
      "the authors be held liable for any damages arising from the use of this software.",
      "Permission is granted to anyone to use this software for any purpose, including commercial "
      "applications, and to alter it and redistribute it freely, subject to the following "
      "restrictions:",
      "The origin of this software must not be misrepresented; you must not claim that you wrote "
      "the original software.",
      "Altered source versions must be plainly marked as such, and must not be misrepresented as "
      "being the original software."),
     ("origin of this software must not be misrepresented",)),
    ("bsl-1.0",
     ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy "
      "of the software and accompanying documentation covered by this license (the Software) to "
      "use, reproduce, display, distribute, execute, and transmit the Software, and to prepare "
      "derivative works of the Software, and to permit third-parties to whom the Software is "
      "furnished to do so",), ("any person or organization obtaining a copy",)),
    ("mpl-2.0-notice",
     ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
      "copy of the MPL was not distributed with this file, You can obtain one at",),
     ("mozilla public license",)),
    ("epl-2.0-notice",
     ("This program and the accompanying materials are made available under the terms of the "
      "Eclipse Public License 2.0 which is available at",), ("eclipse public license 2 0",)),
    ("cddl-notice",
     ("The contents of this file are subject to the terms of the Common Development and "
      "Distribution License (the License). You may not use this file except in compliance with the "
      "License.",
      "When distributing Covered Code, include this CDDL HEADER in each file and include the "
      "License file"), ("common development and distribution license",)),
    ("unlicense",
     ("This is free and unencumbered software released into the public domain. Anyone is free to "
      "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
      "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
      "means.",
      "In jurisdictions that recognize copyright laws, the author or authors of this software "
      "dedicate any and all copyright interest in the software to the public domain."),
     ("free and unencumbered software released into the public domain",)),
    ("cc0-1.0-notice",
     ("To the extent possible under law, the author(s) have dedicated all copyright and related and "
      "neighboring rights to this software to the public domain worldwide. This software is "
      "distributed without any warranty.",), ("all copyright and related and neighboring rights",)),
    ("wtfpl",
     ("Everyone is permitted to copy and distribute verbatim or modified copies of this license "
      "document, and changing it is allowed as long as the name is changed.",),
     ("as long as the name is changed",)),
    ("artistic-2.0-notice",
     ("This program is free software; you may redistribute it and/or modify it under the terms of "
      "the Artistic License 2.0.",), ("artistic license 2 0",)),
    ("postgresql",
     ("Permission to use, copy, modify, and distribute this software and its documentation for any "
      "purpose, without fee, and without a written agreement is hereby granted, provided that the "
      "above copyright notice and this paragraph and the following two paragraphs appear in all "
      "copies.",), ("without a written agreement is hereby granted",)),
    ("ncsa",
     ("to deal with the Software without restriction, including without limitation the rights to "
      "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
      "Software",
      "Redistributions of source code must retain the above copyright notice, this list of "
      "conditions and the following disclaimers.",
      "may be used to endorse or promote products derived from this Software without specific prior "
      "written permission."), ("deal with the software without restriction", "following disclaimers")),
    ("curl",
     ("Permission to use, copy, modify, and distribute this software for any purpose with or without "
      "fee is hereby granted, provided that the above copyright notice and this permission notice "
      "appear in all copies.",
      "Except as contained in this notice, the name of a copyright holder shall not be used in "
      "advertising or otherwise to promote the sale, use or other dealings in this Software without "
      "prior written authorization of the copyright holder."),
     ("name of a copyright holder shall not be used in advertising",)),
    ("ofl-1.1-notice",
     ("This Font Software is licensed under the SIL Open Font License, Version 1.1. This license is "
      "copied below, and is also available with a FAQ at",), ("sil open font license version 1 1",)),
    ("ms-pl",
     ("This license governs use of the accompanying software. If you use the software, you accept "
      "this license. If you do not accept the license, do not use the software.",
      "If you distribute any portion of the software, you must retain all copyright, patent, "
      "trademark, and attribution notices that are present in the software."),
     ("this license governs use of the accompanying software",)),
    ("eupl-1.2-notice",
     ("Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European "
      "Commission subsequent versions of the EUPL (the Licence); You may not use this work except "
      "in compliance with the Licence.",), ("subsequent versions of the eupl",)),
)

EXTENDS = {"bsd-3-clause": ("bsd-2-clause",), "bsd-4-clause": ("bsd-2-clause",),
           "x11": ("mit-text", "mit-0"), "mit-text": ("mit-0",), "curl": ("isc",)}
