"""Licence families and paragraphs they are known by, one string a paragraph."""

TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "You are free to share and adapt the material for any purpose, even commercially, provided "
        "that you give appropriate credit.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License.",
        "You may not use the material for commercial purposes.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
        "If you remix, transform, or build upon the material, you must distribute your contributions "
        "under the same license as the original.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. "
        "If not, see https://www.gnu.org/licenses/.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "Released under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "public-domain": [
        "This work is released into the public domain.",
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
}

# Names and short notices of the families, as in titles and headers.
SHORT = {
    "apache": ["Apache License", "Apache License 2.0", "Licensed under Apache 2.0",
               "License: Apache-2.0"],
    "bsd": ["BSD License", "BSD 3-Clause License", "Licensed under the BSD License",
            "License: BSD"],
    "cc-by": ["CC BY 4.0", "License: CC BY 4.0"],
    "cc-by-nc": ["CC BY-NC 4.0", "License: CC BY-NC 4.0"],
    "cc-by-sa": ["CC BY-SA 4.0", "License: CC BY-SA 4.0"],
    "gpl": ["GNU General Public License", "GNU GPL", "Licensed under GPLv2",
            "Licensed under GPLv3", "License: GPL-2.0", "License: GPL-3.0",
            "Licensed under the GPL"],
    "lgpl": ["GNU Lesser General Public License", "Licensed under LGPLv2.1",
             "License: LGPL-3.0", "Licensed under the LGPL"],
    "mit": ["MIT License", "The MIT License (MIT)", "Licensed under MIT", "License: MIT"],
    "mpl": ["Mozilla Public License", "Mozilla Public License 2.0", "License: MPL-2.0"],
    "public-domain": ["Public domain", "CC0 1.0 Universal", "License: CC0", "The Unlicense"],
}

# Notices that reserve rights or name no known licence.
RIGHTS = [
    "All rights reserved.",
    "All rights reserved by the author.",
    "Copyright (c) 2020 The Authors. All rights reserved.",
    "Copyright 2015-2021 The Company, Inc. All rights reserved.",
    "Copyright (c) 2018 Jane Doe",
    "Copyright 2022 by the authors.",
    "Proprietary and confidential.",
    "Confidential and proprietary. Do not distribute.",
    "Unauthorized copying of this file, via any medium, is strictly prohibited.",
    "No part of this publication may be reproduced without the prior written permission of the "
    "publisher.",
    "Licensed under a commercial license.",
    "Use is subject to license terms.",
    "See the LICENSE file for license terms.",
]

# Paragraphs that share words with licences and are none.
OTHERS = [
    "The driver showed a licence that was no longer valid, and the officer let the car go.",
    "A fishing license is required by applicable law in most of the region.",
    "The software is distributed to all schools at the start of the year.",
    "You may not use this entrance, except in case of fire.",
    "Permission to enter was granted free of charge to any person with a ticket.",
    "The work was released in the spring and reviewed under the old title.",
    "The general public was free to see the files at the foundation.",
    "Version 3 of the report, or any later version, can be had on request.",
    "The above notice shall be included in all letters sent by the office.",
    "The copyright holder is named on the first page of the book.",
    "The conditions of the contract are met if the goods are delivered.",
    "See the manual for the specific language of each form.",
]
