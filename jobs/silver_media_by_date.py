from reelstat.plans.cli import silver_media_by_date

if __name__ == "__main__":
    print("[silver_media_by_date] rows written:", silver_media_by_date())
