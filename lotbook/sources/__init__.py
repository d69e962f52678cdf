"""Where rows come from and go to: delimited feeds, scratch tables, the warehouse tables."""
