"""Stage-1 loads as files arrive."""
