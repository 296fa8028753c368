"""Phrases and template texts that licence scans look for (public licence wordings)."""

from __future__ import annotations

#: Phrases whose every place is reported, with their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Template texts, with their labels.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
            "of the Software"),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the "
               "License at"),
    ("warranty-disclaimer", "Unless required by applicable law or agreed to in writing, software distributed under "
                            "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
                            "ANY KIND, either express or implied"),
    ("warranty-disclaimer", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("all-rights-reserved", "All rights reserved"),
]
