"""Known licences: fixed values, as published. Short notices are the one-line statements that name a licence.

Long texts are files of the folder ``licences``: SPDX id without "only" or "or later" (the text is the same), after "_" another printing.
"""

import re
from importlib import resources

_WARRANTY_MIT = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_WARRANTY_ISC = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

LICENCES = [
    ("MIT", """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

""" + _WARRANTY_MIT),
    ("ISC", """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

""" + _WARRANTY_ISC),
    ("0BSD", """BSD Zero Clause License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

""" + _WARRANTY_ISC),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + "\n\n" + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

""" + _BSD_TAIL),
    ("Unlicense", """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
]



def printings(text: str) -> set[str]:
    """A long text as it is passed on: with or without what follows its terms, wrapped or not, with http or https addresses."""
    end = re.search(r"END OF TERMS AND CONDITIONS", text)
    found = {text, text[: end.end()]} if end else {text}
    found |= {re.sub(r"(?mi)^(?!\s*copyright \(c\))(.*\S)[ \t]*\n(?=[ \t]*\S)", r"\1 ", t) for t in found}
    return found | {t.replace("https://", "http://") for t in found} | {re.sub("http://", "https://", t) for t in found}


def full_texts() -> list[tuple[str, str]]:
    files = sorted((f for f in resources.files(__package__).joinpath("licences").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    return [(f.name[:-4].split("_")[0], f.read_text("utf-8")) for f in files]


LICENCES += [(name, t) for name, text in full_texts() for t in sorted(printings(text))]

# Spellings that count as equal in licence texts, each with the one used here.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"), ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"), ("licences", "licenses"), ("maximise", "maximize"),
    ("modelled", "modeled"), ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("sub licence", "sublicense"), ("sub license", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
]
