"""Standard headers and texts of the common licences, however their lines are broken."""

import random
import re

import pytest

from tidemark.llm import license_scan

GNU = ("{} is free software: you can redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation, "
       "either version {} of the License, or (at your option) any later version.")
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
       "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
       "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
       "documentation and/or other materials provided with the distribution.\n")
CASES = {
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\n'
                  "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n",
    "MIT": 'MIT License\n\nCopyright (c) 2020 Foo\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
           'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
           'merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, '
           'subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial '
           'portions of the Software.',
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
           "copyright notice and this permission notice appear in all copies.",
    "BSD-2-Clause": "Copyright 2020 Foo\nAll rights reserved.\n\n" + BSD,
    "BSD-3-Clause": BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
                          "from this software without specific prior written permission.",
    "GPL-3.0-or-later": GNU.format("This program", "GNU General Public License", 3),
    "GPL-2.0-or-later": GNU.format("This program", "GNU General Public License", 2),
    "LGPL-2.1-or-later": GNU.format("This library", "GNU Lesser General Public License", 2.1),
    "AGPL-3.0-or-later": GNU.format("This program", "GNU Affero General Public License", 3),
    "GPL-2.0-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as "
                    "published by the Free Software Foundation.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def licences(text):
    scanner = license_scan.Scanner()
    return [f[0] for f in scanner.licences([s[0] for s in scanner.sentences(text)])]


@pytest.mark.parametrize("licence", sorted(CASES))
def test_standard_notices_however_broken(licence):
    text = CASES[licence]
    assert licences(text) == [licence]
    assert licences("Some prose. More of it\n" + re.sub("^", " * ", text, flags=re.M) + "\nand code") == [licence]
    assert licences(re.sub(r"(?<![.:;]) ", "\n# ", text)) == [licence]  # a word a line, behind comment marks
    words = text.split(" ")
    rng = random.Random(licence)
    assert licences("".join(w + rng.choice([" ", "\n", "\n\n  "]) for w in words)) == [licence]


def test_inline_notices():
    assert licences("// SPDX-License-Identifier: MIT") == ["MIT"]
    assert licences("/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR MIT */") == ["(GPL-2.0-only WITH Linux-syscall-note) OR MIT"]
    assert licences("(c) 2020 Foo, all rights reserved") == ["proprietary"] and licences("Copyright © 2020 Foo. All rights reserved.") == ["proprietary"]
    assert licences("SPDX-License-Identifier:") == [] and licences("Copyright 2020 Foo") == []
    assert licences("the mit license is short\nnot all rights reserved here\nlicensed") == []
    assert licences("licensed\n" * 3000 + "#\n" * 3000 + "Released under the MIT License") == ["MIT"]


def test_spans_and_brute_force():
    """Every known sentence in every gap of prose is found where it stands."""
    scanner = license_scan.Scanner()
    for name, sentence in license_scan.SENTENCES:
        text = f"Prose before it.\n{sentence}.\nProse behind."
        assert scanner.sentences(text) == [(scanner.known[license_scan.normalised(sentence)], 17, 17 + len(sentence) + 1)], sentence
