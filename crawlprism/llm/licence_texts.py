"""Sentences of licence notices by family, other legal sentences, and ordinary ones with the same words."""

FAMILIES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Licensed under CC0 1.0 Universal.",
        "This work has been dedicated to the public domain.",
    ],
}

#: Legal sentences of no family above.
UNKNOWN = [
    "All rights reserved.",
    "Copyright by the author, all rights reserved worldwide.",
    "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher.",
    "Use of this service is subject to the terms and conditions of the agreement.",
    "This software is proprietary and confidential; unauthorized copying is strictly prohibited.",
    "The licensee shall not sublicense, rent or lease the software to any third party.",
    "Reproduction is permitted for private study only.",
    "Licensed to the subscriber under the terms of the end user license agreement.",
    "Distributed under a custom license that is available on request.",
    "The content may be used with the written permission of the copyright holder.",
]

#: Ordinary sentences with words of the notices.
ORDINARY = [
    "She renewed her driving license at the office last week.",
    "The public library offers free copies of the daily paper.",
    "This version of the story is not the one he told before.",
    "The terms of the contract were discussed at the meeting.",
    "They work on the source of the river in the mountains.",
    "The software runs on any machine in the office.",
    "He asked for permission to leave the room early.",
    "A general was seen with his file of documents.",
    "The foundation gives money to free concerts in the park.",
    "Common sense and creative work are not opposites.",
    "The notice on the door said that the shop was closed.",
    "Her rights were read to her by the officer in charge.",
    "The form must be returned to the department by Friday.",
    "Most of the products are made without sugar.",
    "The conditions on the road were worse than the year before.",
    "You can obtain a ticket at the counter of the museum.",
]
