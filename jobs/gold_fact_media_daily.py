from reelstat.plans.cli import gold_fact_media_daily

if __name__ == "__main__":
    print("[gold_fact_media_daily] rows written:", gold_fact_media_daily())
