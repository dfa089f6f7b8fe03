"""Findings of the second round: word salads, alphabets, licence texts."""

import random
from pathlib import Path

import pytest

from treeshred.llm import language, licenses, quality_rules


def made_language(seed, letters, space=" "):
    """Texts of a made-up language: a quarter of the words are its twelve common ones, of Zipfian weight."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(letters) for _ in range(rnd.randint(3, 8)))
    common, other = [word() for _ in range(12)], [word() for _ in range(3000)]
    weights = [1 / (k + 1) for k in range(12)]
    text = lambda n=200: space.join(rnd.choices(common, weights)[0] if rnd.random() < 0.3 else rnd.choice(other) for _ in range(n))
    return text, lambda: space.join(rnd.choice(other) for _ in range(200))


LATIN = "abcdefghijklmnoprstuvw"


def test_word_salad_is_rejected_in_each_language(spark):
    made = {name: made_language(k, LATIN) for k, name in enumerate(("en", "de", "xx"))}
    rows = [(100 * k + i, made[name][0](), name) for k, name in enumerate(made) for i in range(40)]
    rows += [(1000 + k, made[name][1](), name) for k, name in enumerate(made)]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(r.kept for i, r in got.items() if i < 1000)
    assert all(not got[1000 + k].base_failed and not got[1000 + k].kept and got[1000 + k].word_share > 0.95 for k in range(3))


def test_languages_without_a_reference_are_kept(spark):
    text, _ = made_language(1, LATIN)
    japanese, _ = made_language(6, "日本語文字列漢和英訳書", "")
    rows = [(i, text(), "en") for i in range(40)]
    rare = {100: ("it", made_language(2, LATIN)[0]()), 101: ("ru", made_language(3, "абвгдежзиклмнопрст")[0]()),
            102: (None, made_language(4, "абвгдежзиклмнопрст")[0]()), 103: (None, made_language(5, LATIN)[0]()),
            104: ("ja", "\n".join(japanese(12) for _ in range(90)))}
    rows += [(i, text, lang) for i, (lang, text) in rare.items()]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not [(r.doc_id, r.base_failed, r.class_distance, r.word_share) for r in got.values() if r.base_failed or not r.kept]
    assert all(got[i].word_share is None for i in rare)


def test_every_letter_of_the_training_text_counts():
    one, two = [chr(0x5000 + i) for i in range(100)], [chr(0x6000 + i) for i in range(300)]
    model = language.LanguageModel({"a": "".join(one) * 20, "b": "".join(two) * 10})
    assert model.predict(["".join(two[40:240]), "".join(one[10:60])])[0] == ["b", "a"]
    assert len(set(language._unpacked(model.symbols)[[ord(c) for c in one + two]])) == 400


APACHE_HEADER = """Copyright 2021 Jane
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    https://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and limitations under the License."""
BSD_2 = """BSD 2-Clause License

Copyright (c) 2021, Jane
All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
SYSTEM = Path("/usr/share/common-licenses")


def licenses_of(spark, texts):
    found = licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [r.license for r in sorted(found, key=lambda r: r.doc_id)]


def test_common_licence_texts(spark):
    clause = "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived\nfrom this software without specific prior written permission.\n\nTHIS SOFTWARE"
    bsd_3 = BSD_2.replace("2-Clause", "3-Clause").replace("\nTHIS SOFTWARE", clause, 1)
    assert licenses_of(spark, [APACHE_HEADER, BSD_2, bsd_3, BSD_2 + " x"]) == ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", None]


@pytest.mark.skipif(not SYSTEM.is_dir(), reason="no licence texts on this system")
def test_licence_texts_of_the_system(spark):
    files = {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1",
             "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    assert licenses_of(spark, [(SYSTEM / f).read_text() for f in files]) == list(files.values())
