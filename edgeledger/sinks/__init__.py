"""Writers. Each write of a batch replaces what an earlier try of that batch left."""
