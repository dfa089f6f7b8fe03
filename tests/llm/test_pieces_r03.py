"""The cache of piece ids."""

from treeshred.llm import pieces


def test_frequent_pieces_outlive_those_that_come_once():
    asked = []

    def encode(parts):
        asked.extend(parts)
        return [[ord(c) for c in p] for p in parts]

    encoder = pieces.PieceEncoder(encode, {}, pieces.classes(pieces.packed_classes()), 20)
    for i in range(60):
        text = f"often x{chr(0x4E00 + i)} y{chr(0x4E00 + i)} z{chr(0x4E00 + i)}"
        ids, bounds = encoder.ids([text])
        assert ids.tolist() == [ord(c) for c in text] and bounds.tolist() == [0, len(text)]
    assert asked.count("often") == 1 and len(asked) == 181
    assert len(encoder.index) <= 20


def test_known_pieces_are_looked_up_once():
    again = []

    class Index(dict):
        def __getitem__(self, piece):
            again.append(piece)
            return super().__getitem__(piece)

    encoder = pieces.PieceEncoder(lambda parts: [[ord(c) for c in p] for p in parts], {}, pieces.classes(pieces.packed_classes()))
    encoder.ids(["one two three"])
    encoder.index = Index(encoder.index)
    text = "one two three four"
    assert encoder.ids([text])[0].tolist() == [ord(c) for c in text] and again == [" four"]


def test_a_piece_is_looked_up_once_for_all_its_places():
    asked = []

    class Index(dict):
        def get(self, piece, *default):
            asked.append(piece)
            return super().get(piece, *default)

    encoder = pieces.PieceEncoder(lambda parts: [[ord(c) for c in p] for p in parts], {}, pieces.classes(pieces.packed_classes()))
    encoder.index = Index(encoder.index)
    texts = ["é one one", "", " one\U0001F600 one \ud800 é é", "one"]
    ids, bounds = encoder.ids(texts)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [[ord(c) for c in t] for t in texts]
    assert len(asked) == len(set(asked)) and asked.count(" one") == 1
