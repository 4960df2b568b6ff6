"""Wording of well-known licence notices, by SPDX-like name."""

NOTICES = {
    "MIT-line": "Released under the MIT License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
