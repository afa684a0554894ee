"""DataFrame -> DataFrame operators: EAV pivots, term lookups, filters,
upserts and key checks, snapshot appends, backfill bookkeeping."""
