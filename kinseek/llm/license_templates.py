"""Wordings of common licences and notices, in template markup.

Fixed values. `<<beginOptional>>` to `<<endOptional>>` may be left out, `<<var;words=A..B>>`
stands for A to B words of any kind. Case, punctuation and white space do not matter.
"""

#: Statements that count wherever their words stand consecutively.
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

TEMPLATES = {
    "mit-text": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of
        <<var;words=1..12>> (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or
        sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
        subject to the following conditions: The above copyright notice and this permission notice
        <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies
        or substantial portions of the Software.
        <<beginOptional>>THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT. IN NO EVENT SHALL <<var;words=1..12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
        LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
        WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.<<endOptional>>""",
    "isc-text": """
        Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software
        for any purpose with or without fee is hereby granted, provided that the above copyright notice
        and this permission notice appear in all copies.""",
    "bsd-2-text": """
        Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions
        of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation
        and/or other materials provided with the distribution.""",
    "bsd-3-text": """
        Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions
        of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation
        and/or other materials provided with the distribution. <<beginOptional>>3.<<endOptional>> Neither
        the name of <<var;words=1..16>> may be used to endorse or promote products derived from this
        software without specific prior written permission.""",
    "zlib-text": """
        This software is provided 'as-is', without any express or implied warranty. In no event will the
        <<var;words=1..6>> be held liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose""",
    "unlicense-text": """
        This is free and unencumbered software released into the public domain.
        <<beginOptional>>Anyone is free to copy, modify, publish, use, compile, sell, or distribute this
        software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means.<<endOptional>>""",
    "apache-2-notice": """
        Licensed under the Apache License, Version 2.0 <<beginOptional>>(the "License"); you may not use
        <<var;words=1..4>> except in compliance with the License. You may obtain a copy of the License at
        <<beginOptional>>http<<beginOptional>>s<<endOptional>>://www.apache.org/licenses/LICENSE-2.0
        <<endOptional>><<endOptional>>""",
    "gpl-notice": """
        under the <<beginOptional>>terms of the<<endOptional>> GNU <<beginOptional>>Lesser<<endOptional>>
        <<beginOptional>>Affero<<endOptional>> General Public License
        <<beginOptional>>as published by the Free Software Foundation<<endOptional>>
        <<beginOptional>>either<<endOptional>> version <<var;words=1..1>>
        <<beginOptional>>of the License<<endOptional>>
        <<beginOptional>>or (at your option) any later version<<endOptional>>""",
    "mpl-2-notice": """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
        <<beginOptional>>If a copy of the MPL was not distributed with this file, You can obtain one at
        http<<beginOptional>>s<<endOptional>>://mozilla.org/MPL/2.0/<<endOptional>>""",
    "cc-notice": """
        licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>>
        <<beginOptional>>Creative Commons<<endOptional>> <<beginOptional>>CC<<endOptional>>
        <<beginOptional>>Attribution<<endOptional>> BY <<beginOptional>>NC<<endOptional>>
        <<beginOptional>>SA<<endOptional>> <<beginOptional>>ND<<endOptional>> <<var;words=1..1>> 0""",
}
