"""Where rows come from and go to: tables, files, topics, wire formats."""
