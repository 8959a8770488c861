"""Headers, licence texts and tags by which files state common licences.

Of licences of many pages the title and the opening stand for the text.
"""

_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the
{name} as published by the Free Software Foundation, either version {version} of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
{name} for more details. You should have received a copy of the {name} along with this program."""

_GNU_OPENING = """{name} Version {version} Copyright (C) Free Software Foundation, Inc. Everyone is permitted
to copy and distribute verbatim copies of this license document, but changing it is not allowed."""

_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution. {third} THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
_BSD_SHORT = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met"""

_GPL, _LGPL, _AGPL = (
    "GNU General Public License", "GNU Lesser General Public License", "GNU Affero General Public License"
)

#: (SPDX identifier, text); a licence may have several.
BLOCKS = [
    ("AGPL-3.0", _GNU.format(name=_AGPL, version=3)),
    ("AGPL-3.0", _GNU_OPENING.format(name=_AGPL, version=3)),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""),
    ("Apache-2.0", """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS
FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "License" shall mean the terms and conditions for use,
reproduction, and distribution as defined by Sections 1 through 9 of this document. "Licensor" shall mean the
copyright owner or entity authorized by the copyright owner that is granting the License."""),
    ("BSD-2-Clause", _BSD.format(third="")),
    ("BSD-3-Clause", _BSD.format(third=_THIRD)),
    ("BSD-3-Clause", _BSD_SHORT),
    ("CC-BY-4.0", """Creative Commons Attribution 4.0 International Public License. By exercising the Licensed
Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons
Attribution 4.0 International Public License ("Public License")."""),
    ("CC-BY-NC-4.0", """Creative Commons Attribution-NonCommercial 4.0 International Public License. By exercising
the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative
Commons Attribution-NonCommercial 4.0 International Public License ("Public License")."""),
    ("CC-BY-SA-4.0", """Creative Commons Attribution-ShareAlike 4.0 International Public License. By exercising the
Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons
Attribution-ShareAlike 4.0 International Public License ("Public License")."""),
    ("CC-BY-SA-4.0", """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International
License"""),
    ("CC0-1.0", """Creative Commons Legal Code CC0 1.0 Universal. Statement of Purpose. The laws of most
jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (defined below) upon
the creator and subsequent owner(s) (each and all, an "owner") of an original work of authorship and/or a database
(each, a "Work")."""),
    ("CC0-1.0", """To the extent possible under law, the author(s) have dedicated all copyright and related and
neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.
You should have received a copy of the CC0 Public Domain Dedication along with this software."""),
    ("GPL-2.0", _GNU.format(name=_GPL, version=2)),
    ("GPL-2.0", _GNU_OPENING.format(name=_GPL, version="2, June 1991")),
    ("GPL-3.0", _GNU.format(name=_GPL, version=3)),
    ("GPL-3.0", _GNU_OPENING.format(name=_GPL, version="3, 29 June 2007")),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS."""),
    ("LGPL-2.1", _GNU.format(name=_LGPL, version="2.1").replace("program", "library")),
    ("LGPL-2.1", _GNU_OPENING.format(name=_LGPL, version="2.1, February 1999")),
    ("LGPL-3.0", _GNU.format(name=_LGPL, version=3)),
    ("LGPL-3.0", _GNU.format(name=_LGPL, version=3).replace("program", "library")),
    ("LGPL-3.0", _GNU_OPENING.format(name=_LGPL, version="3, 29 June 2007")),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("MIT", "Licensed under the MIT license"),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("MPL-2.0", """Mozilla Public License Version 2.0. 1. Definitions. 1.1. "Contributor" means each individual or
legal entity that creates, contributes to the creation of, or owns Covered Software. 1.2. "Contributor Version" means
the combination of the Contributions of others (if any) used by a Contributor and that particular Contributor's
Contribution."""),
]
_SUFFIXED = ["AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0"]
BLOCKS += [(x, f"SPDX-License-Identifier: {x}") for x in sorted({x for x, _ in BLOCKS})]
BLOCKS += [(x, f"SPDX-License-Identifier: {x}-{end}") for x in _SUFFIXED for end in ("only", "or-later")]
