"""The registered queries, the inputs they derive, and their SQL twins."""
