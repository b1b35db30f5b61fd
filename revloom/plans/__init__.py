"""End-to-end jobs: run(sources, ...) -> {output name: DataFrame}. Lazy, without I/O; "today" is an argument."""
