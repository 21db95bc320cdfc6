"""Licence rules on known texts."""

from scanloom.llm import licenses as L

MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
"""
APACHE = """// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
// You may obtain a copy of the License at
//
//     http://www.apache.org/licenses/LICENSE-2.0
"""


def scan(spark, rows):
    return {r.doc_id: r for r in L.scan(spark.createDataFrame(rows, "doc_id bigint, text string, rules int")).collect()}


def test_rules(spark):
    got = scan(spark, [(1, MIT, 0), (2, GPL, 0), (3, APACHE, 0), (4, "Prose here\nReleased under the MIT License.", 0), (5, "Licensed under CC BY-NC 4.0. And more.", 0),
                       (6, "This work is licensed under the GNU General Public License, version 3.\nLicensed under the Apache License, Version 2.0.", 0), (7, "It is licensed.", 0)])
    assert got[1].licences == "MIT" and got[1].classes == "permissive"
    assert got[3].licences == "Apache-2.0" and got[4].licences == "MIT"
    assert (got[5].licences, got[5].classes) == ("CC-BY-NC-4.0", "non-commercial")
    assert (got[6].licences, got[6].classes) == ("Apache-2.0,GPL-3.0", "permissive,copyleft") and got[7].licences == ""


def test_order_counts(spark):
    first, second = (L.SENTENCES[i - 1].capitalize() + "." for i in (11, 12))
    got = scan(spark, [(1, f"{first} {second}", 0), (2, f"{second} {first}", 0)])
    full = next(k for k, r in enumerate(L.RULES) if r[2] == (11, 12))
    assert str(full) in got[1].rules.split(",") and str(full) not in got[2].rules.split(",")


def test_odd_inputs(spark):
    got = scan(spark, [(1, None, 0), (2, "", 0), (3, "x. " * 50000 + "Released under the MIT License.", 0)])
    assert got[1].licences == got[2].licences == "" and got[3].licences == "MIT"
    df = spark.createDataFrame([(None, "MIT License", 1), (None, "MIT License", 1)], "doc_id bigint, text string, classes int")
    assert [r.licences for r in L.scan(df).collect()] == ["MIT", "MIT"] and L.scan(df.filter("false")).collect() == []


FREE = "This {0} is free software{1} you can redistribute it and/or\nmodify it under the terms of the GNU {2}General Public\nLicense as published by the Free Software Foundation{3} either\nversion {4} of the License, or (at your option) any later version.\n\nThis {0} is distributed in the hope that it will be useful,\n"
APACHE_2 = """   Copyright 2020 Somebody

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       {}://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. {} */
"""
MPL_2 = "If a copy of the MPL was not distributed with this\n * file, You can obtain one at {}://mozilla.org/MPL/2.0/."
BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = BSD_2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and{} distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
CC = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
#: A notice for each rule, in their order.
NOTICES = [
    APACHE_2.format("http"), APACHE, "Licensed under the Apache License, Version 2.0.", "# Copyright X\n# SPDX-License-Identifier: Apache-2.0\n#\nimport os",
    MIT, MIT.split("The above")[0], "Released under the MIT License.", "Licensed under the MIT License.", "MIT License\n\nCopyright (c) X", "The MIT License (MIT)", "// Copyright X\n// SPDX-License-Identifier: MIT\nint x;",
    FREE.format("program", ":", "", ";", "3"), FREE.format("program", ";", "", ";", "2"), FREE.format("program", ";", "Lesser ", ";", "3"), FREE.format("program", ";", "Lesser ", ";", "2.1"), FREE.format("program", ":", "Affero ", ";", "3"),
    "This work is licensed under the GNU General Public License, version 3.", "This work is licensed under the GNU General Public License, version 2.", "/* SPDX-License-Identifier: GPL-3.0-or-later */",
    BSD_3, BSD_2, "SPDX-License-Identifier: BSD-3-Clause", MPL.format(MPL_2.format("http")), MPL.format("See there."), ISC.format("/or"), "This is free and unencumbered software released into the public domain.",
    *(f"Licensed under CC {k} 4.0." for k in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")), CC.format(""), CC.format("-ShareAlike"), CC.format("-NonCommercial"),
    FREE.format("program", ":", "", ",", "3"), FREE.format("program", ":", "", ",", "2"), FREE.format("program", ":", "Lesser ", ",", "3"), FREE.format("program", ":", "Lesser ", ",", "2.1"), FREE.format("program", ":", "Affero ", ",", "3"),
    FREE.format("library", ";", "Lesser ", ";", "3"), FREE.format("library", ";", "Lesser ", ";", "2.1"), FREE.format("library", ":", "Lesser ", ",", "3"), FREE.format("library", ":", "Lesser ", ",", "2.1"),
    APACHE_2.format("https"), MPL.format(MPL_2.format("https")), ISC.format(""),
]


def test_every_rule_on_its_notice(spark):
    assert len(NOTICES) == len(L.RULES)
    got = scan(spark, [(-1, GPL, 0), *((k, t, 0) for k, t in enumerate(NOTICES))])
    assert (got[-1].licences, got[-1].classes) == ("GPL-3.0-or-later", "copyleft")
    for k, (name, kind, _) in enumerate(L.RULES):
        assert (got[k].licences, got[k].classes) == (name, kind) and str(k) in got[k].rules.split(","), (k, got[k])
