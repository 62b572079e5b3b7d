"""Licence wording to look for, in SPDX template markup (see ``licences``), and the phrases that name a licence."""

from __future__ import annotations

#: Phrases that name a licence, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_COPYRIGHT = '<<beginOptional>><<var;name="copyright";match="copyright .{1,30}">><<endOptional>>'
_WORK = '<<var;name="work";match="program|software|library|file|work|code|document|text|page|project|package|material|content">>'
_GRANTED = '<<var;name="verb";match="released|licensed|distributed|published|available|provided|shared">>'
_TERMS = "<<beginOptional>>the terms of<<endOptional>> the"
_WARRANTY_BSD = """
THIS SOFTWARE IS PROVIDED BY <<var;name="provider";match=".{1,20}">> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL <<var;name="holder";match=".{1,20}">> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BULLET = '<<beginOptional>><<var;name="bullet";match="1|2|3|a|b|c|i|ii|iii">><<endOptional>>'
_BSD = f"""
{_COPYRIGHT} <<beginOptional>>All rights reserved.<<endOptional>>
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
{_BULLET} Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
{_BULLET} Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_NO_ENDORSEMENT = f"""
{_BULLET} Neither the name of <<var;name="organisation";match=".{{1,20}}">> nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission."""


def _gnu(name: str, version: str, later: bool) -> str:
    wording = f"under {_TERMS} GNU {name} <<beginOptional>>as published by the Free Software Foundation,<<endOptional>> "
    wording += f"<<beginOptional>>either<<endOptional>> version {version}"
    if later:
        wording += " <<beginOptional>>of the license<<endOptional>> or <<beginOptional>>(at your option)<<endOptional>> any later version"
    return f'<<beginOptional>>This {_WORK} is<<endOptional>> <<beginOptional>>{_GRANTED}<<endOptional>> {wording}'


def _notices(label: str, *names: str) -> list[tuple[str, str]]:
    """Sentences that put something under a licence of one of these names."""
    return [(label, f"<<beginOptional>>This {_WORK} is<<endOptional>> {_GRANTED} under <<beginOptional>>{_TERMS}<<endOptional>> {name}")
            for name in names]


#: The wording of well-known licences and of the notices that files carry. A label may have several templates.
TEMPLATES = [
    ("MIT", f"""
<<beginOptional>><<beginOptional>>The<<endOptional>> MIT License<<endOptional>> {_COPYRIGHT}
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be
included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
<<var;name="holder";match=".{{1,20}}">> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    *_notices("MIT", "mit license", "x11 license", "mit x11 license", "mit open source license"),
    ("BSD-2-Clause", _BSD + _WARRANTY_BSD),
    ("BSD-3-Clause", _BSD + _NO_ENDORSEMENT + _WARRANTY_BSD),
    *_notices("BSD-2-Clause", "bsd 2 clause license", "2 clause bsd license", "simplified bsd license"),
    *_notices("BSD-3-Clause", "bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"),
    ("ISC", f"""
<<beginOptional>>ISC License<<endOptional>> {_COPYRIGHT}
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name="provider";match=".{{1,10}}">> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;name="holder";match=".{{1,10}}">> BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    *_notices("ISC", "isc license"),
    ("Zlib", """
This software is provided 'as-is', without any express or implied warranty. In no event will
<<var;name="holder";match=".{1,10}">> be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
<<beginOptional>>1.<<endOptional>> The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated
but is not required.
<<beginOptional>>2.<<endOptional>> Altered source versions must be plainly marked as such, and must not be misrepresented as being
the original software.
<<beginOptional>>3.<<endOptional>> This notice may not be removed or altered from any source distribution."""),
    ("BSL-1.0", """
Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the
Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do
so, all subject to the following:"""),
    ("Unlicense", """
This is free and unencumbered software released into the public domain.
<<beginOptional>>Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code
form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.<<endOptional>>"""),
    ("Apache-2.0", f"""
Licensed <<beginOptional>>to <<var;name="owner";match=".{{1,30}}">><<endOptional>> under the Apache License, Version 2.0
<<beginOptional>>(the "License"); you may not use this <<var;name="file";match="file|work|software">> except in compliance with the
License. You may obtain a copy of the License at <<beginOptional>>http<<beginOptional>>s<<endOptional>>://www.apache.org/licenses/LICENSE-2.0
<<endOptional>> Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.<<endOptional>>"""),
    *_notices("Apache-2.0", "apache license 2 0", "apache license version 2 0", "apache 2 0 license"),
    ("GPL-2.0", _gnu("General Public License", "2", False)),
    ("GPL-3.0", _gnu("General Public License", "3", False)),
    ("GPL-2.0-or-later", _gnu("General Public License", "2", True)),
    ("GPL-3.0-or-later", _gnu("General Public License", "3", True)),
    ("AGPL-3.0", _gnu("Affero General Public License", "3", False)),
    ("LGPL-2.1", _gnu("Lesser General Public License", "2.1", False)),
    ("LGPL-3.0", _gnu("Lesser General Public License", "3", False)),
    ("MPL-2.0", """
<<beginOptional>>This Source Code Form is<<endOptional>> subject to the terms of the Mozilla Public License,
<<beginOptional>>v.<<endOptional>> <<beginOptional>>version<<endOptional>> 2.0"""),
    *_notices("CC0-1.0", "cc0", "creative commons zero license"),
    *(notice for code, name in [("by", "attribution"), ("by-sa", "attribution sharealike"), ("by-nd", "attribution noderivatives"),
                                ("by-nc", "attribution noncommercial"), ("by-nc-sa", "attribution noncommercial sharealike"),
                                ("by-nc-nd", "attribution noncommercial noderivatives")]
      for version in ["3.0", "4.0"]
      for notice in _notices(f"CC-{code.upper()}-{version}", f"cc {code} {version}", f"creative commons {name} {version}",
                             f"creative commons {name} license {version}"))
]
