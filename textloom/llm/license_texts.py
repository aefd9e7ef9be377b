"""License families by their notices, headers and texts: fixed values, templates of the license scan.

MIT and Unlicense are whole, BSD, ISC and zlib are their grants and conditions. Of the long texts (GPL, LGPL,
AGPL, MPL, Apache, CC0) there is a passage of up to 120 words near the beginning, which every whole copy holds.
"""

FAMILIES = {
    "agpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version."
    ),
    "agpl-3.0-name": "GNU Affero General Public License, version 3",
    "agpl-3.0-text": (
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, "
        "specifically designed to ensure cooperation with the community in the case of network server software."
    ),
    "agpl-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General "
        "Public License for more details."
    ),
    "apache-2.0-text": (
        "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the "
        "terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this "
        "document. \"Licensor\" shall mean the copyright owner or entity authorized by the copyright owner that is "
        "granting the License. \"Legal Entity\" shall mean the union of the acting entity and all other entities "
        "that control, are controlled by, or are under common control with that entity. For the purposes of this "
        "definition, \"control\" means (i) the power, direct or indirect, to cause the direction or management of "
        "such entity, whether by contract or otherwise, or (ii) ownership of fifty percent (50%) or more of the "
        "outstanding shares, or (iii)"
    ),
    "boost-1.0-header": "Distributed under the Boost Software License, Version 1.0.",
    "bsd-3-clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."
    ),
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
        "COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED."
    ),
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-4.0-name": "Creative Commons Attribution 4.0 International",
    "cc-by-nc-4.0-name": "Creative Commons Attribution-NonCommercial 4.0 International",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-sa-4.0-name": "Creative Commons Attribution-ShareAlike 4.0 International",
    "cc0-1.0-name": "Creative Commons CC0 1.0 Universal",
    "cc0-1.0-text": (
        "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related "
        "Rights (defined below) upon the creator and subsequent owner(s) (each and all, an \"owner\") of an "
        "original work of authorship and/or a database (each, a \"Work\"). Certain owners wish to permanently "
        "relinquish those rights to a Work for the purpose of contributing to a commons of creative, cultural and "
        "scientific works (\"Commons\") that the public can reliably and without fear of later claims of "
        "infringement build upon, modify, incorporate in other works, reuse and redistribute as freely as "
        "possible in any form whatsoever and for any purposes, including without limitation commercial purposes. "
        "These owners may contribute to the Commons to promote the ideal of a free"
    ),
    "gpl-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, or "
        "(at your option) any later version."
    ),
    "gpl-2.0-name": "GNU General Public License, version 2",
    "gpl-2.0-text": (
        "The licenses for most software are designed to take away your freedom to share and change it. By "
        "contrast, the GNU General Public License is intended to guarantee your freedom to share and change free "
        "software--to make sure the software is free for all its users. This General Public License applies to "
        "most of the Free Software Foundation's software and to any other program whose authors commit to using "
        "it. (Some other Free Software Foundation software is covered by the GNU Lesser General Public License "
        "instead.) You can apply it to your programs, too. When we speak of free software, we are referring to "
        "freedom, not price. Our General Public Licenses are designed to make sure that you have the"
    ),
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "gpl-3.0-name": "GNU General Public License, version 3",
    "gpl-3.0-text": (
        "The GNU General Public License is a free, copyleft license for software and other kinds of works. The "
        "licenses for most software and other practical works are designed to take away your freedom to share and "
        "change the works. By contrast, the GNU General Public License is intended to guarantee your freedom to "
        "share and change all versions of a program--to make sure it remains free software for all its users. We, "
        "the Free Software Foundation, use the GNU General Public License for most of our software; it applies "
        "also to any other work released this way by its authors. You can apply it to your programs, too. When we "
        "speak of free software, we are referring to freedom, not"
    ),
    "gpl-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details."
    ),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies."
    ),
    "lgpl-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
        "License, or (at your option) any later version."
    ),
    "lgpl-2.1-name": "GNU Lesser General Public License, version 2.1",
    "lgpl-2.1-text": (
        "The licenses for most software are designed to take away your freedom to share and change it. By "
        "contrast, the GNU General Public Licenses are intended to guarantee your freedom to share and change "
        "free software--to make sure the software is free for all its users. This license, the Lesser General "
        "Public License, applies to some specially designated software packages--typically libraries--of the Free "
        "Software Foundation and other authors who decide to use it. You can use it too, but we suggest you first "
        "think carefully about whether this license or the ordinary General Public License is the better strategy "
        "to use in any particular case, based on the explanations below. When we speak of free software, we are "
        "referring to"
    ),
    "lgpl-3.0-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 3 of the "
        "License, or (at your option) any later version."
    ),
    "lgpl-3.0-name": "GNU Lesser General Public License, version 3",
    "lgpl-3.0-text": (
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 "
        "of the GNU General Public License, supplemented by the additional permissions listed below. 0. "
        "Additional Definitions. As used herein, \"this License\" refers to version 3 of the GNU Lesser General "
        "Public License, and the \"GNU GPL\" refers to version 3 of the GNU General Public License. \"The Library\" "
        "refers to a covered work governed by this License, other than an Application or a Combined Work as "
        "defined below. An \"Application\" is any work that makes use of an interface provided by the Library, but "
        "which is not otherwise based on the Library. Defining a subclass of a class defined by the Library is"
    ),
    "lgpl-warranty": (
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General "
        "Public License for more details."
    ),
    "mit-available": "Available under the MIT License.",
    "mit-distributed": "Distributed under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-terms": "Under the terms of the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
        "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"
    ),
    "mpl-2.0-name": "Mozilla Public License, version 2.0",
    "mpl-2.0-text": (
        "1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, "
        "or owns Covered Software. 1.2. \"Contributor Version\" means the combination of the Contributions of "
        "others (if any) used by a Contributor and that particular Contributor's Contribution. 1.3. "
        "\"Contribution\" means Covered Software of a particular Contributor. 1.4. \"Covered Software\" means Source "
        "Code Form to which the initial Contributor has attached the notice in Exhibit A, the Executable Form of "
        "such Source Code Form, and Modifications of such Source Code Form, in each case including portions "
        "thereof. 1.5. \"Incompatible With Secondary Licenses\" means (a) that the initial Contributor has attached "
        "the notice described in Exhibit B to the Covered Software; or (b) that the Covered Software was"
    ),
    "unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize "
        "copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
        "software to the public domain. We make this dedication for the benefit of the public at large and to the "
        "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
        "perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS "
        "PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT "
        "OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
        "THE SOFTWARE. For more information, please refer to <http://unlicense.org/>"
    ),
    "zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
        "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
        "use this software for any purpose, including commercial applications, and to alter it and redistribute "
        "it freely, subject to the following restrictions:"
    ),
}
