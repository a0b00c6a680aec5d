"""The continuous corpus: keyed upserts, live rollups, and the loop that picks, fetches and stores."""
