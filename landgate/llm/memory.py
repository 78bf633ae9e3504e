"""What a worker remembers of pieces of text it has already encoded."""

#: Bytes of an entry besides its characters: two objects, its slot in the table, and that of a late key.
SLOT = 200


class Memory(dict):
    """A dict of texts to bytes whose lasting entries are held in ``most`` bytes; they are the first ones and so
    the frequent ones. Later entries, and any of over ``longest`` bytes, stay until they hold ``recent`` bytes
    together. A character counts as four bytes, which is the most it takes."""

    def __init__(self, most: int, recent: int, longest: int = 1 << 10):
        super().__init__()
        self.most, self.recent, self.longest = most, recent, longest
        self.lasting, self.passing, self.late = 0, 0, []

    def add(self, key: str, value: bytes) -> None:
        size = SLOT + 4 * len(key) + len(value)
        self[key] = value
        if size <= self.longest and self.lasting + size <= self.most:
            self.lasting += size
        else:
            self.passing += size
            self.late.append(key)

    def forget(self) -> None:
        """Call between uses: drops late entries if they hold too much."""
        if self.passing > self.recent:
            for key in self.late:
                self.pop(key, None)
            self.late, self.passing = [], 0
