"""Licence notices by family."""

from __future__ import annotations

# Names by which texts refer to the licences.
NAMES = {
    "mit": ("MIT License", "MIT license", "Expat License", "MIT"),
    "apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0", "Apache License version 2.0"),
    "bsd": ("BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "3-Clause BSD License", "BSD-3-Clause", "BSD-2-Clause", "New BSD License"),
    "gpl-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GPL version 2", "GPL-2.0", "GPLv2", "GNU GPL version 2"),
    "gpl-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GPL version 3", "GPL-3.0", "GPLv3", "GNU GPL version 3"),
    "lgpl": ("GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License, version 3",
             "LGPL version 2.1", "LGPL version 3", "LGPL-2.1", "LGPL-3.0", "LGPLv3"),
    "agpl-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License", "AGPL version 3", "AGPL-3.0", "AGPLv3"),
    "mpl-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "MPL-2.0", "MPL 2.0"),
    "isc": ("ISC License", "ISC license"),
    "unlicense": ("Unlicense", "The Unlicense"),
    "cc0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal", "CC0-1.0"),
    "cc-by": ("CC BY 4.0", "CC BY 3.0", "CC-BY-4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 3.0 License"),
    "cc-by-sa": ("CC BY-SA 4.0", "CC BY-SA 3.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License",
                 "Creative Commons Attribution-ShareAlike 3.0 License"),
    "cc-by-nc": ("CC BY-NC 4.0", "CC BY-NC 3.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License",
                 "Creative Commons Attribution-NonCommercial 3.0 License"),
}

# Sentences that name a licence.
STATEMENTS = (
    "{}", "Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "Released under {}.", "Distributed under the {}.",
    "This work is licensed under the {}.", "This work is licensed under {}.", "This work is licensed under a {}.",
    "This project is licensed under the terms of the {}.", "This software is released under the {}.", "This program is distributed under the terms of the {}.",
    "This file is part of a project under the {}.", "Available under the {}.", "SPDX-License-Identifier: {}", "License: {}", "Content is available under {}.",
)

# The notices themselves.
NOTICES = {
    "mit": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to '
        "deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a '
        "copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations "
        "under the License.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND "
        "ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "gpl-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 "
        "Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    ),
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        "FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
        "Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ),
    "agpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can "
        "obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS.",
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA "
        "OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide "
        "under copyright law.",
    ),
    "cc-by": (
        "You are free to share and adapt the material for any purpose, even commercially. You must give appropriate credit, provide a link to the license, and "
        "indicate if changes were made.",
    ),
    "cc-by-sa": (
        "If you remix, transform, or build upon the material, you must distribute your contributions under the same license as the original.",
    ),
    "cc-by-nc": (
        "You may not use the material for commercial purposes.",
    ),
}

# Sentences that speak of licences or permissions without granting one.
NO_LICENSE = (
    "He lost his driver's license after the accident.", "The city requires a business license for every shop.", "Licensed physicians must renew their license.",
    "All rights reserved.", "The hunting license is valid for one season.", "She is a licensed therapist in this state.", "The software costs nothing for students.",
    "A fishing license can be bought at the lake.", "The general public is invited to the meeting.", "This work is part of a larger study of the region.",
    "The version is available in the shop under the counter.", "The terms of the agreement were published in the newspaper.",
    "Permission to enter the building was granted by the guard.", "Without warranty the machine is cheaper.", "The free software movement started in the eighties.",
    "You can obtain a copy of the report at the office.", "Commercial use of the hall is not permitted on Sundays.",
)
