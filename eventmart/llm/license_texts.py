"""Phrases and templates of the license scan."""

from __future__ import annotations

# --- fixed values: phrases whose places are counted, and their labels -----------------------
PHRASES = [
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
]

# --- fixed values: notices as the licenses give them, and the usual short statements ---------
TEMPLATES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    (
        "mit",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        " \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,"
        " use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any"
        " purpose, commercial or non-commercial, and by any means.",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
]
