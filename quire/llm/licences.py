"""Licence templates and base phrases (fixed values): lower-case words decide, punctuation doesn't.

The notices are the short forms that their licences ask to be put into files.
"""

#: Phrase -> label of the base rule.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: (label, text) of the templates.
TEMPLATES = [
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("lgpl-3", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("agpl-3", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]
