"""Templates of licence notices: label, notice, and the phrases that it must contain."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Template:
    label: str
    notice: str
    key_phrases: tuple[str, ...]


# Wording of public licence notices.
TEMPLATES = (
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Licensed under the MIT License", ("mit license",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template("apache-2", "Licensed under the Apache License, Version 2.0", ("apache license version 2",)),
    Template(
        "gpl-3",
        "This work is licensed under the GNU General Public License, version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        "gpl-2-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version",
        ("gnu general public license", "either version 2"),
    ),
    Template(
        "gpl-3-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
        ("gnu general public license", "either version 3"),
    ),
    Template(
        "lgpl-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version",
        ("gnu lesser general public license", "either version 2 1"),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee is hereby granted",),
    ),
    Template(
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license v 2",),
    ),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template(
        "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        ("creative commons attribution noncommercial",),
    ),
    Template("cc-by", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template(
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution 4 0",),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
)

# Phrases that are looked for in any case, and their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
