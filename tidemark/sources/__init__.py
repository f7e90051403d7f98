"""Where rows come from: topics, lake layers and fixed dimensions."""
