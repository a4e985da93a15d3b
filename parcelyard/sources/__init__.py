"""Where rows come from and where tables go."""
